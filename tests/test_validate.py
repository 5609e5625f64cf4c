import json

from sieveline.operators import validate
from sieveline.plans import pipeline

GOOD = {
    "id": "a" * 64, "text": "t" * 200,
    "meta": {
        "data_info": {"lang": "en", "url": "https://x/1", "source": "x", "type": "HowTo", "processing_date": "2025-9-4", "delivery_version": "V1.0", "title": "t", "content": "plain words"},
        "content_info": {"domain": "Cooking", "subdomain": "Recipes"}, "collector": "joy", "collected_time": "2025-09-04T10:00",
    },
}


def variant(**changes):
    out = json.loads(json.dumps(GOOD))
    for path, value in changes.items():
        at = out
        *heads, last = path.split("__")
        for h in heads:
            at = at[h]
        if value is KeyError:
            del at[last]
        else:
            at[last] = value
    return out


def tags(spark, lines):
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines, 1)], "path string, line int, value string")
    out = {i: [] for i in range(1, len(lines) + 1)}
    for r in validate.findings(validate.with_findings(validate.from_lines(df))).orderBy("line", "ord").collect():
        out[r.line].append((r.tag, r.msg))
    return [out[i] for i in sorted(out)]


def test_structure(spark):
    cases = [
        (GOOD, []), (variant(id=KeyError), ["缺少字段 `id`"]), (variant(id=None), ["id 需为 32/40/64 位 hex"]), (variant(text=KeyError), ["缺少字段 `text`", "文本长度 < 200"]), (variant(text=5), ["`text` 必须为字符串"]),
        (variant(text="t" * 199 + "😀"), []), (variant(meta=None), ["缺少或非法字段 `meta`"]), (variant(meta__data_info=5), ["缺少或非法字段 `meta.data_info`"]), (variant(meta__data_info__title=KeyError), ["缺少字段 `meta.data_info.title`"]),
        (variant(meta__content_info=KeyError), ["缺少或非法字段 `meta.content_info`"]), (variant(meta__data_info__processing_date="2025-02-30"), ["meta.data_info.processing_date 非 'YYYY-MM-DD'"]),
        (variant(meta__data_info__processing_date="0000-01-01"), ["meta.data_info.processing_date 非 'YYYY-MM-DD'"]), (variant(meta__data_info__lang=["en"]), ["meta.data_info.lang 仅允许 'en' 或 'zh'"]), (variant(meta__data_info__content=None), ["`meta.data_info.content` 必须为字符串"]),
        (variant(meta__content_info={}), ["缺少字段 `meta.content_info.domain`", "缺少字段 `meta.content_info.subdomain`", "meta.content_info.domain 不在允许集合 ['Cooking', 'Daily Life']", "meta.content_info.subdomain 不在允许集合 ['Cleaning', 'Recipes']"]),
    ]
    got = tags(spark, [json.dumps(c) for c, _ in cases])
    for (_, want), have in zip(cases, got):
        assert [m for _, m in have] == want


def test_lines(spark):
    got = tags(spark, ["", "  ", "not json", '{"a":1} x', "[1]", "5", '"s"', "null", "{}"])
    assert [[t for t, _ in x] for x in got[:8]] == [["R1"]] * 8
    assert [t for t, _ in got[8]] == ["R1", "R1", "R1", "R9"]


def test_content_rules(spark):
    suffix = {
        "\n\nend": ["R3"], "\n# head": ["R2"], "\nJump to Recipe": ["R2"], " 😀": ["R3"], " ，。": ["R3"], "\n    indented": ["R3"], " <b>x</b> &amp;": ["R4"], " subscribe to our newsletter": ["R4"],
        "\n![i](https://x/y.png)": ["R5"], "\n| a | b |": ["R5"], " 2 × 3": ["R5"], " $2 × 3$": [], " see https://x/y.jpg now": ["R5"], " 4111-1111-1111-1111": ["R6"], " 123-45-6789 xxxx": ["R6", "R6"], "\n- item": ["R3"],
        "\n[Image: https://x/y.jpg]": [], "\n[Image: https://x/y.jpg?w=1]": [], " preferences": [], " references": ["R4"], " \\[a ≤ b\\] ≥": ["R5"], " a@b.co": ["R6"], " 743-555-3824": ["R6"],
    }
    got = tags(spark, [json.dumps(variant(meta__data_info__content="plain words" + s)) for s in suffix])
    assert {s: [t for t, _ in g] for s, g in zip(suffix, got)} == suffix


def test_pipeline_over_files(spark, tmp_path):
    lines = [json.dumps(GOOD), "", "oops", json.dumps(variant(id="B" * 64)), json.dumps(variant(id="b" * 64, meta__data_info__url=" https://x/1 "))]
    (tmp_path / "a.jsonl").write_text("\r\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_bytes(b'{"x": "\xff"}\n')
    (tmp_path / "c.jsonl").write_text("")
    out = pipeline.validate(spark, [str(tmp_path)], strict=True)
    rows = {(r.path.rsplit("/", 1)[-1], r.line, r.tag) for r in out.findings.collect()}
    assert {("a.jsonl", 2, "R1"), ("a.jsonl", 3, "R1"), ("a.jsonl", 4, "DUP_URL"), ("a.jsonl", 5, "DUP_URL"), ("a.jsonl", 5, "DUP_ID"), ("b.jsonl", 0, "R1"), ("c.jsonl", 0, "R1")} <= rows
    totals = {(r.path or "").rsplit("/", 1)[-1]: (r.total, r.passed, round(r.pass_rate, 2)) for r in out.summary.collect()}
    assert totals["a.jsonl"] == (4, 3, 75.0) and totals[""] == (4, 3, 75.0)


def test_empty_table(spark, sf):
    df = spark.read.parquet(f"{sf}/example_clean.parquet").select("path", "line", "id", "text", "meta").limit(0)
    found = validate.with_findings(validate.from_table(df))
    assert validate.findings(found).count() == 0
    assert validate.duplicate_ids(validate.from_table(df)).count() == 0
    assert [(r.total, r.pass_rate) for r in validate.summary(found).where("path IS NULL").collect()] in ([(0, 0.0)], [])
