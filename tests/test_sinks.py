import json

from pyspark.sql import functions as F

from sieveline.operators import clean, preview
from sieveline.plans import pipeline
from sieveline.sources import sinks
from sieveline.streaming import watch


def lines(folder):
    return sorted(x for f in folder.glob("**/part-*") for x in f.read_text(encoding="utf-8").splitlines())


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", "too_short")], "url string, reason string")
    sinks.write_jsonl(df.select(F.struct("url", "reason").alias("r")), "r", str(tmp_path / "clean"))
    assert [json.loads(x) for x in lines(tmp_path / "clean")] == [{"url": "b", "reason": "too_short"}, {"url": "é", "reason": None}]
    sinks.write_rejected(df, str(tmp_path / "rejected"))
    assert lines(tmp_path / "rejected") == ['{"url":"\\u00e9","reason":null}', '{"url":"b","reason":"too_short"}']
    sinks.write_jsonl(df.select(F.struct("url").alias("r")), "r", str(tmp_path / "clean"))  # a rerun replaces
    assert len(lines(tmp_path / "clean")) == 2


def test_names(spark):
    row = spark.range(1).select(sinks.part_name("20250101_1000", F.lit(3)).alias("p"), sinks.volume_name("20250101", F.lit(2)).alias("v"), preview.preview_name(F.lit("in/a.clean.jsonl")).alias("h"), preview.preview_name(F.lit("b.jsonl")).alias("g")).first()
    assert tuple(row) == ("site_20250101_1000_part03.jsonl", "20250101_clean_file_2.jsonl", "in/preview_a.html", "preview_b.html")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a/x.html", "1"), ("b.html", "2")], "path string, html string")
    assert sinks.write_files(df, "path", "html", str(tmp_path)) == 2
    assert (tmp_path / "a" / "x.html").read_text() == "1"


def test_named_files(spark, tmp_path):
    rows = [(f"v{i % 3}/a b={i % 3}.jsonl", -i, f"line {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "name string, o int, v string").repartition(5)
    for _ in range(2):  # a rerun replaces
        names = sinks.write_named(df, "name", ["o"], "v", str(tmp_path), always=("none.jsonl",))
    assert names == ["none.jsonl", *(f"v{k}/a b={k}.jsonl" for k in range(3))]
    assert (tmp_path / "v1" / "a b=1.jsonl").read_text().splitlines() == [f"line {i}" for i in range(28, 0, -3)]
    assert (tmp_path / "none.jsonl").read_text() == "" and not list(tmp_path.glob("_writing*"))


def test_parts_have_names(spark, tmp_path):
    parts = sinks.rolling(spark.range(25).select(F.lit("f").alias("p"), F.col("id").alias("l"), F.col("id").cast("string").alias("v")), ["p"], ["l"], 10)
    assert sinks.write_parts(parts, "v", str(tmp_path), "20250101_1000") == [f"site_20250101_1000_part0{i}.jsonl" for i in (1, 2, 3)]
    assert (tmp_path / "site_20250101_1000_part02.jsonl").read_text().split() == [str(i) for i in range(10, 20)]


def test_report_and_preview_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.clean.jsonl").write_text("oops\n" * 3)
    (tmp_path / "in" / "b.jsonl").write_text("")
    (tmp_path / "in" / "c.jsonl").write_bytes(b'{"id": "\xff"}\n')
    said = []
    result = pipeline.validate(spark, str(tmp_path / "in"))
    pipeline.write_reports(result, "T", say=said.append)
    own = (tmp_path / "in" / "a.clean.report.txt").read_text().splitlines()
    assert own[:2] == ["Validate Report (T)", f"File: {tmp_path}/in/a.clean.jsonl"] and own[-1] == "Summary: total=3 passed=0 pass_rate=0.00%" and len(own) == 8
    assert said == ["[SUMMARY] total=3 passed=0 pass_rate=0.00%"]
    assert any("UTF-8" in r.msg and r.path.endswith("c.jsonl") for r in result.findings.collect())
    assert pipeline.write_previews(spark, str(tmp_path / "in" / "a.clean.jsonl"), str(tmp_path / "one.html"), say=said.append) == [str(tmp_path / "one.html")]
    many = pipeline.write_previews(spark, str(tmp_path / "in" / "a*.jsonl"), str(tmp_path / "pages") + "/", per_page=2, say=said.append)
    assert [x.rsplit("/", 1)[1] for x in many] == ["preview_a.2.html", "preview_a.html"] and "<section" in (tmp_path / "pages" / "preview_a.html").read_text()


def test_first_seen(spark):
    assert clean.first_seen(spark.createDataFrame([("a",), ("a",), (None,)], "url string"), ["url"]).count() == 2


def test_reports_of_a_run(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("oops\n")
    each, overall = pipeline.reports(pipeline.validate(spark, str(tmp_path)), "T")
    assert any("ERROR [R1] JSON" in r.text for r in each.collect()) and overall.where("text LIKE 'Summary: total=1 passed=0%'").count() == 1


def test_streams(spark, tmp_path):
    for i, body in enumerate(['{"u":"a","t":"2025-01-01T00:00:00"}\n{"u":"a","t":"2025-01-01T00:01:00"}\n', '{"u":"b","t":"2025-01-01T09:00:00"}\n']):
        (tmp_path / f"{i}.json").write_text(body)
    stream = spark.readStream.schema("u string, t timestamp").json(str(tmp_path))

    def run(df, name, mode):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c_{name}")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        return spark.table(name).collect()

    assert sorted(r.u for r in run(watch.first_urls(stream, "u", "t"), "firsts", "append")) == ["a", "b"]
    assert sorted((r.u, r.n) for r in run(watch.rates(stream, "t", "u"), "rates", "complete")) == [("a", 2), ("b", 1)]
    assert sorted(r.clean for r in run(watch.cleaned(stream, "u"), "cleaned", "append")) == ["a", "a", "b"]
