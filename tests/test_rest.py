import json

import pytest
from pyspark.sql import functions as F

from sieveline.functions import html
from sieveline.operators import clean, extract, preview, urls, volumes
from sieveline.plans import pipeline
from sieveline.sources import config, jsonl, sinks


@pytest.mark.parametrize(
    ("n", "soft_max", "least", "sizes"),
    [(0, 9, 10, [0]), (10, 9, 10, [10]), (11, 9, 10, [11]), (19, 9, 10, [19]), (20, 9, 10, [10, 10]), (25, 9, 5, [10, 10, 5]), (24, 9, 5, [10, 14])],
)
def test_volumes(spark, n, soft_max, least, sizes):
    df = spark.range(n).select(F.lit("f").alias("path"), F.col("id").alias("line"))
    merged = volumes.merge_volumes(df, ["path"], ["line"], soft_max, least)
    assert [r.lines for r in volumes.volume_sizes(merged).orderBy("volume").collect()] == sizes
    if n:
        assert [r.idx for r in merged.orderBy("line").collect()] == list(range(n))


def test_volume_formula_equals_writing(spark):
    cases = [(n, soft, least) for n in range(1, 60, 3) for soft, least in ((3, 2), (9, 10), (9, 5))]
    for n, soft, least in cases:
        want, count = [[]], 0
        for i in range(n):
            if count > soft:
                want.append([])
                count = 0
            want[-1].append(i)
            count += 1
        if len(want) > 1 and len(want[-1]) < least:
            tail = want.pop()
            want[-1] += tail
        df = spark.range(n).select("id", volumes.volume_of(F.col("id"), F.lit(n), soft, least).alias("v"))
        if n in (1, 22, 40, 58):
            assert [r.v for r in df.orderBy("id").collect()] == [i + 1 for i, part in enumerate(want) for _ in part]


def test_global_index_of_millions_with_payload(spark):
    n = 3_000_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("k"), "id", F.concat(F.lit("row "), "id").alias("payload"))
    got = volumes.global_index(df, [], ["k", "id"], buckets=32)
    least, most, distinct = got.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()
    assert (least, most, distinct) == (0, n - 1, n)
    # each row after the first follows a smaller one, and carries its own payload
    later = got.select((F.col("idx") + 1).alias("idx"), F.struct("k", "id").alias("before"))
    wrong = got.join(later, "idx").where((F.col("before") >= F.struct("k", "id")) | (F.col("payload") != F.concat(F.lit("row "), "id")))
    assert wrong.count() == 0


def test_rolling_parts(spark):
    df = spark.range(20).select(F.lit("f").alias("p"), F.col("id").alias("l"))
    assert sorted(r["count"] for r in sinks.rolling(df, ["p"], ["l"], 10).groupBy("part").count().collect()) == [10, 10]


PAGE = """<html><head><meta property="og:image" content="http://i/og.jpg"><script type="application/ld+json">{bad</script>
<script type="application/ld+json">{"@graph": [{"@type": ["Thing", "Recipe"], "name": "LD title", "image": {"url": "http://i/ld.jpg"},
"recipeIngredient": ["1 egg", "2 cups flour"], "recipeInstructions": [{"@type": "HowToSection", "name": "First", "itemListElement": [{"text": "Beat well"}]}, "Bake it"]}]}</script></head>
<body><h1> My &amp; dish </h1><p>one<p>two<br>three <script>var t="</p>"</script><!-- no --><article><img data-src="http://i/a.jpg"><source srcset="http://i/b.jpg 1x, http://i/c.jpg 2x"></article>
<div class="ing x"><ul><li>salt<li>pepper</ul><div class="skip">no</div></div><a href=" /next ">n</a><a href="#x">x</a><a href="mailto:a">m</a><link rel="next" href="http://p/2"></body></html>"""


def test_tree_and_selectors():
    root = html.parse(PAGE)
    pick = lambda s: [n.text(" ") for n in html.select(root, s)]
    assert pick("h1") == ["My & dish"]
    assert pick("p") == ["one", "two three"]
    assert pick(".ing li") == ["salt", "pepper"] == pick("div.ing > ul > li") == pick('div[class="ing x"] li')
    assert pick(".ing :not(.skip):not(ul)") == ["salt", "pepper"]
    assert pick("h1, li") == ["My & dish", "salt", "pepper"]
    for bad in ("h1::attr(x)", "h1::text", "", "a >", "p:first-child"):
        if bad == "a >":
            continue
        with pytest.raises(html.SelectorError):
            html.select(root, bad)
    assert html.select_all(root, ["x::attr(content)", "h1", "h1"])[0].tag == "h1" and len(html.select_all(root, ["h1", "h1"])) == 2


def test_extraction(spark):
    pages = spark.createDataFrame([("http://p/1", PAGE), ("http://p/none", None)], "url string, html string")
    got = {r.url: r for r in extract.raw_fields(pages, "url", "html", {"ingredients": {"all": [".ing li"]}}).collect()}
    one = got["http://p/1"]
    assert (one.page.title, one.page.images, one.page.ingredients) == ("My & dish", ["http://i/a.jpg", "http://i/b.jpg"], "salt\npepper")
    assert (one.ld.title, one.ld.images, one.ld.ingredients, one.ld.instructions) == ("LD title", ["http://i/ld.jpg"], "1 egg\n2 cups flour", "First\nBeat well\nBake it")
    assert got["http://p/none"].error == "RuntimeError"
    ok = pages.where("html IS NOT NULL")
    assert [r.href for r in extract.links(ok, "url", "html").collect()] == ["/next"]
    assert [r.href for r in extract.links(ok, "url", "html", first=False).orderBy("pos").collect()] == ["/next", "#x", "mailto:a"]
    assert [r.next for r in extract.next_pages(ok, "url", "html").collect()] == ["http://p/2"]
    made = {r.url: r for r in extract.articles(pages, "url", "html", {}, {"type": "HowTo"}, "2025-01-01", "2025-01-01T00:00", 20).collect()}
    assert made["http://p/none"].reason == "exception:RuntimeError"
    record = made["http://p/1"].record
    assert record.text.startswith("My & dish\n[Image: http://i/a.jpg]\nIngredients:\n1 egg") and len(record.id) == 64
    part = extract.parts(ok, "url", "html", {"title": ["h2", "h1"], "ingredients": ".ing"}).collect()[0]
    assert (part.title, part.cover_image, part.instructions_html) == ("My & dish", "http://i/og.jpg", None) and part.ingredients_html.startswith('<div class="ing x">')


def test_fragment_text(spark):
    df = spark.createDataFrame([('<p>a<img src="u.jpg"> b</p><table><tr><td>no</table><script>x</script>',), (None,)], "h string")
    assert [r.t for r in df.select(extract.fragment_text(F.col("h")).alias("t")).collect()] == ["a\n[Image: u.jpg]\nb", None]


def test_rules():
    assert urls.rule_parts(["/a.b/", "Shop", "", 5, "/(/"]) == (["a.b"], ["shop", "("])
    assert urls.rule_parts({"a": 1}) == ([], [])
    assert extract.selectors_of({"any": ["a", ""]}) == ["a"] and extract.selectors_of(None) == []


def test_frontier(spark):
    df = spark.createDataFrame([("https://X/Recipe/1",), ("https://x/shop/1",), (None,), ("https://x/about",)], "url string")
    allowed = [r.a for r in df.select(urls.url_allowed(F.col("url"), ["/recipe/"], ["shop"]).alias("a")).collect()]
    assert allowed == [True, False, False, False]
    assert [r.u for r in df.select(urls.normalize_url(F.concat("url", F.lit("/a//#frag"))).alias("u")).collect()][0] == "https://X/Recipe/1/a"
    hrefs = spark.createDataFrame([("http://h/a/b", "../c"), ("http://h/a/b", "/r"), ("http://h/a", "http://o/x"), ("http://h/a/b", "d?e=1"), ("http://h", None)], "b string, h string")
    assert [r.u for r in hrefs.select(urls.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()] == ["http://h/c", "http://h/r", "http://o/x", "http://h/a/d?e=1", None]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "page string, next string")
    start = spark.createDataFrame([("a",)], "page string")
    assert sorted((r.page, r.step) for r in urls.follow(start, edges, 2).collect()) == [("a", 1), ("b", 2)]


def test_sitemaps(spark):
    xml = [
        ("r", '<?xml version="1.0"?><sitemapindex xmlns="http://s"><sitemap><loc> a </loc></sitemap><sitemap><loc>b</loc></sitemap><sitemap><loc>r</loc></sitemap></sitemapindex>'),
        ("a", '<urlset xmlns="http://s"><url><loc>\n p1 </loc></url><url><loc>p2</loc></url></urlset>'), ("b", "<loc>p3</loc><loc>http://x/sitemap-2.xml</loc> & broken"),
    ]
    docs = extract.sitemap_links(spark.createDataFrame(xml, "u string, x string"), "u", "x")
    pages = urls.walk_sitemaps(spark.createDataFrame([("r",)], "url string"), docs)
    assert sorted(r.url for r in pages.collect()) == ["p1", "p2", "p3"]


def test_config(tmp_path):
    (tmp_path / "a.yml").write_text("domain: x.test\ndiscover: {index_pages: 'https://x.test/', extra: 1}\n")
    (tmp_path / "b.yml").write_text("selectors: {}\n")
    good, bad = config.load_configs(str(tmp_path))
    assert [(c.domain, c.index_pages, c.sitemap) for c in good] == [("x.test", ["https://x.test/"], True)]
    assert bad[0][1].startswith("KeyError")


def test_scrape(spark):
    site = config.SiteConfig("p", index_pages=["http://p/1"], selectors={"ingredients": ".ing li"})
    pages = spark.createDataFrame([("http://p/1", PAGE), ("/next", PAGE)], "url string, html string")
    found = pipeline.discover(spark, site, pages, max_pages=2)
    assert [r.url for r in found.collect()] == ["/next"]
    wanted = found.union(spark.createDataFrame([("http://gone",)], "url string"))
    ok, rejected = pipeline.scrape(spark, site, wanted, pages, "2025-01-01", "2025-01-01T00:00", min_chars=10)
    assert ok.count() == 1 and [r.reason for r in rejected.collect()] == ["exception:RuntimeError"]


def test_many_sites(spark, tmp_path):
    (tmp_path / "conf").mkdir()
    for name in ("a", "b"):
        (tmp_path / "conf" / f"{name}.yml").write_text(f"domain: {name}.test\ndiscover: {{index_pages: ['http://{name}.test/'], sitemap: false, deny: [skip]}}\nselectors: {{ingredients: .ing li}}\nmeta: {{type: HowTo}}\n")
    (tmp_path / "conf" / "c.yml").write_text("selectors: {}\n")
    index = lambda n: f'<a href="http://{n}.test/1">x</a><a href="http://{n}.test/gone">x</a><a href="http://{n}.test/skip">x</a>'
    pages = spark.createDataFrame([(f"http://{n}.test/", index(n)) for n in "ab"] + [(f"http://{n}.test/1", PAGE) for n in "ab"], "url string, html string")
    said = []
    runs = pipeline.run_sites(spark, str(tmp_path / "conf"), str(tmp_path / "out"), "2025-01-01", "T", pages, min_chars=10, say=said.append)
    assert sorted((r.site.rsplit("/", 1)[-1], r.accepted, r.rejected, r.error is None) for r in runs) == [("a.test", 1, 1, True), ("b.test", 1, 1, True), ("c.yml", 0, 0, False)]
    record = json.loads((tmp_path / "out" / "a.test.clean.jsonl").read_text())
    assert record["meta"]["data_info"]["url"] == "http://a.test/1" and record["meta"]["data_info"]["source"] == "a.test"
    assert json.loads((tmp_path / "out" / "b.test.rejected.jsonl").read_text()) == {"url": "http://b.test/gone", "reason": "exception:RuntimeError"}
    assert said[-1] == f"[BATCH DONE T] sites=3 total_ok=2 total_rejected=2 out_dir={tmp_path}/out"


def test_discovery_from_entry_pages(spark):
    pages = spark.createDataFrame([("http://s/x/", '<a href="b#f">1</a><a href="/x/a/">2</a><a href="http://o/x/">3</a>'), ("http://s/x/2", '<a href="/x/a">4</a><a href="c?shop">5</a><a href="d">6</a>')], "url string, html string")
    found = pipeline.discover_entries(["http://s/x/", "http://s/x/2", "http://s/gone"], pages, ["http://s/x/"], ["shop"], max_pages=2)
    assert [r.url for r in found.orderBy("entry", "pos").collect()] == ["http://s/x/b", "http://s/x/a", "http://s/x/d"]


def test_jsonld_of_odd_types(spark):
    block = json.dumps([{"@graph": "no"}, 5, {"@type": ["X", "RECIPE"], "name": 7, "image": [" http://i/no", {"@id": "http://i/a"}, {"url": 3}, "http://i/a", "x"], "recipeIngredient": ["salt", 2, " "], "recipeInstructions": [{"text": 12}, {"name": " Mix ", "itemListElement": {"text": True}}, None, "end", {"itemListElement": ["a", {"name": "b", "itemListElement": ["too deep"]}]}]}])
    page = f'<script type="application/ld+json">{block}</script>'
    got = extract.raw_fields(spark.createDataFrame([(1, page)], "k int, h string"), "k", "h", {}).first().ld
    assert (got.title, got.images, got.ingredients, got.instructions) == ("7", ["http://i/a"], "salt\n2", "12\nMix\nTrue\nend\na\nb")


def test_lines_and_preview(spark, tmp_path):
    (tmp_path / "x.clean.jsonl").write_text(json.dumps({"id": "1", "meta": {"data_info": {"title": "T<", "content": "## H\na\nb\n\n[Image: https://i]\n[Image: no]"}}}) + "\n\nbad\n")
    lines = jsonl.read_lines(spark, jsonl.expand_paths(str(tmp_path)))
    assert [(r.line, bool(r.value)) for r in lines.orderBy("line").collect()] == [(1, True), (2, False), (3, True)]
    page = pipeline.preview(spark, str(tmp_path)).collect()[0].html
    assert "T&lt;" in page and "<h3>H</h3>\n<p>a<br>b</p>" in page and "<img src='https://i'" in page and "<p>[Image: no]</p>" in page and "JSON decode error" in page
    assert preview.output_path("/d/x.clean.jsonl") == "deliveries_pre_check/d/preview_x.html"
    assert preview.output_path("/d/x.jsonl", "o/p.html") == "o/p.html"


def test_many_splits_number_lines(spark, tmp_path):
    (tmp_path / "big.jsonl").write_text("".join(f"line {i} {'x' * (i % 50)}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        rows = jsonl.read_lines(spark, [str(tmp_path / "big.jsonl")]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 20000 and all(r.value.startswith(f"line {r.line - 1} ") for r in rows)


def test_ascii_json(spark):
    df = spark.createDataFrame([('{"u":"é中😀"}',), ("plain",)], "v string")
    assert [r.v for r in df.select(sinks.ascii_json(F.col("v")).alias("v")).collect()] == ['{"u":"\\u00e9\\u4e2d\\ud83d\\ude00"}', "plain"]


def test_merge(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join(f"{name}{i}\n" for i in range(12)))
    sizes = pipeline.merge(spark, str(tmp_path / "in" / "*.jsonl"), str(tmp_path / "out"), min_lines=5, soft_max=9)
    assert [r.lines for r in sizes.orderBy("volume").collect()] == [10, 14]
    pipeline.merge(spark, str(tmp_path / "in" / "*.jsonl"), str(tmp_path / "out"), min_lines=5, soft_max=9, day="20250101")
    both = [(tmp_path / "out" / f"20250101_clean_file_{i}.jsonl").read_text().split() for i in (1, 2)]
    assert both == [[f"a{i}" for i in range(10)], ["a10", "a11"] + [f"b{i}" for i in range(12)]]
    none = pipeline.merge(spark, str(tmp_path / "nothing*.jsonl"), str(tmp_path / "empty"), day="20250101")
    assert [tuple(r) for r in none.collect()] == [(1, 0)] and (tmp_path / "empty" / "20250101_clean_file_1.jsonl").read_text() == ""


def test_stream(spark, tmp_path):
    from sieveline.streaming import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("oops\n\n")
    query = watch.stream_findings(watch.arriving_lines(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("found").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination(120)
    assert spark.table("found").count() == 2


def test_record_id(spark):
    assert spark.range(1).select(clean.record_id(F.lit("a")).alias("i")).first().i == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"


def test_rendered_content(spark):
    texts = [None, "", " \n", "a\n b \n\n[Image: HTTP://x/1.png ]\n[Image: no]\n## H & M\r\nend"]
    got = [r.h for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(preview.render_content(F.col("t")).alias("h")).collect()]
    picture = "<div class='img-line'><div class='img-box'><img src='HTTP://x/1.png' alt='image' loading='lazy'></div><div class='img-url'>HTTP://x/1.png</div></div>"
    assert got == [preview.NO_CONTENT, preview.NOTHING_SHOWN, preview.NOTHING_SHOWN, f"<p>a<br> b </p>\n{picture}\n<p>[Image: no]</p>\n<h3>H &amp; M</h3>\n<p>end</p>"]


def test_reports(spark):
    found = spark.createDataFrame([("f", 2, 3, "R1", "m"), ("f", 1, 0, "R2", "n")], "path string, line int, ord int, tag string, msg string")
    rates = spark.createDataFrame([("f", 2, 0, 0.0), ("g", 1, 1, 100.0), (None, 3, 1, 33.333)], "path string, total bigint, passed bigint, pass_rate double")
    lines = sinks.report_lines(found, rates, "T")
    bars = "=" * 80, "-" * 80
    assert [r.text for r in lines.where("path = 'f'").orderBy("seq").collect()] == ["Validate Report (T)", "File: f", bars[0], "f:1: ERROR [R2] n", "f:2: ERROR [R1] m", bars[1], "Summary: total=2 passed=0 pass_rate=0.00%"]
    assert [r.text for r in lines.where("path = 'g'").orderBy("seq").collect()] == ["Validate Report (T)", "File: g", bars[0], "[PASS] 无错误", bars[1], "Summary: total=1 passed=1 pass_rate=100.00%"]
    order = ["path", "line", "seq", "text"]
    assert [r.text for r in sinks.overall_report(found, rates, "T").orderBy(*order).collect()] == ["Validate Report (T)", "Files:", "  - f", "  - g", bars[0], "f:1: ERROR [R2] n", "f:2: ERROR [R1] m", bars[1], "Summary: total=3 passed=1 pass_rate=33.33%"]
    assert [r.text for r in sinks.overall_report(found.limit(0), rates, "T").orderBy(*order).collect()] == ["Validate Report (T)", "Files:", "  - f", "  - g", bars[0], "[PASS] 无错误", bars[1], "Summary: total=3 passed=1 pass_rate=33.33%"]
