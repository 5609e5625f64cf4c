"""Queries of the library's own operators, with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_html
from ..operators import clean, extract, normalize, preview, urls, validate, volumes
from ..sources import config, sinks
from .oracles import ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``rec_no, content`` and named leaves of the delivery records."""
    leaf = {"url": "meta.data_info.url", "title": "meta.data_info.title", "lang": "meta.data_info.lang", "source": "meta.data_info.source"}
    return table(spark, sf_dir, "example_clean").select("rec_no", F.col("meta.data_info.content").alias("content"), *[F.col(leaf.get(m, m)).alias(m) for m in more])


def over_content(step: Callable[[Column], Column]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: records(spark, sf_dir).select("rec_no", step(F.col("content")).alias("clean"))


def over_documents(step: Callable[[Column], Column]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, "documents").select("doc_id", step(F.col("text")).alias("clean"))


# frontier


def record_id(spark, sf_dir):
    return records(spark, sf_dir, "url").select("rec_no", clean.record_id(F.col("url")).alias("id"))


def url_normalize(spark, sf_dir):
    return records(spark, sf_dir, "url").select("rec_no", urls.normalize_url(F.col("url")).alias("url"))


def url_normalize_dedup(spark, sf_dir):
    kept = records(spark, sf_dir, "url").select(urls.normalize_url(F.col("url")).alias("url"))
    return kept.where(urls.prefix_allowed(F.col("url"), ["https://"], ["/recipe/", "?"])).distinct()


def url_allow_deny(spark, sf_dir):
    rules = urls.parsed_rules(config.flat(table(spark, sf_dir, "site_config")), "domain", "allow", "deny")
    rows = records(spark, sf_dir, "url").select("rec_no", "url", urls.host_of(F.col("url")).alias("domain"))
    return rows.join(rules, "domain", "left").select("rec_no", urls.url_allowed_by(F.col("url"), F.col("allow"), F.col("deny")).alias("allowed"))


def url_rule_semi_anti(spark, sf_dir):
    rows = records(spark, sf_dir, "url").where(urls.url_allowed(F.col("url"), ["/-(?:bake|soup|pie)-/", "/recipe/"], ["?", "/tag/"]))
    return rows.select("rec_no", "url")


def frontier_union(spark, sf_dir):
    sites = config.flat(table(spark, sf_dir, "site_config"))
    index = sites.select(F.explode("index_pages").alias("url"))
    maps = sites.where("sitemap").select(urls.sitemap_root(F.col("domain"), F.col("sitemap_url")).alias("url"))
    return urls.frontier(index, maps)


def fetch_left_join(spark, sf_dir):
    wanted = table(spark, sf_dir, "rejected").select("url").unionByName(records(spark, sf_dir, "url").select("url")).where("url IS NOT NULL").distinct()
    pages = records(spark, sf_dir, "url").where("url IS NOT NULL").groupBy("url").agg(F.max("content").alias("content"))
    got = wanted.join(pages, "url", "left")
    return got.select("url", F.when(F.col("content").isNull(), F.lit("exception:RuntimeError")).otherwise(F.lit("fetched")).alias("status"))


def links_first_seen(spark, sf_dir):
    rows = records(spark, sf_dir, "url").where("url IS NOT NULL").select(urls.normalize_url(F.col("url")).alias("url"), "rec_no")
    return urls.first_seen_links(rows, "url", ["rec_no"])


def links_absolute(spark, sf_dir):
    rows = records(spark, sf_dir, "url").where("url IS NOT NULL")
    href = F.concat(F.lit("/tips/"), F.col("rec_no").cast("string"), F.lit("/"))
    return rows.select("rec_no", urls.absolute_url(F.lower("url"), href).alias("url"))


def links_discovered(spark, sf_dir):
    """Anchors of all pages against their page, in normal form, allowed, each where it is seen first."""
    rows = records(spark, sf_dir, "url").where("url IS NOT NULL")
    anchors = rows.select(F.col("rec_no").alias("entry"), F.lower(F.trim("url")).alias("base"), F.lit(0).alias("pos"), F.concat(F.lit("/tips/"), (F.col("rec_no") % 50).cast("string"), F.lit("/#top")).alias("href"))
    return urls.discovered(anchors, ["https://"], ["/tips/7"])


def seen_urls(spark, sf_dir):
    return clean.first_seen(records(spark, sf_dir, "url").select("url"), ["url"])


def limit_sorted(spark, sf_dir):
    """The article limit is the operator itself: the first urls in order."""
    return clean.limit_articles(records(spark, sf_dir, "url").select("url").where("url IS NOT NULL").distinct(), "url", 200)


# cleaning


def build_content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean.build_content(F.col("url"), F.col("title"), F.col("text"), F.col("subdomain")).alias("content"))


def _gated(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "example_clean").select("rec_no", F.col("meta.data_info.url").alias("url"), F.col("meta.data_info.content").alias("content"), "text")
    error = F.when(F.col("content").isNull(), F.lit("RuntimeError"))
    return rows.withColumn("reason", clean.reject_reason(F.col("content"), F.col("text"), error))


def gate_split(spark, sf_dir):
    return _gated(spark, sf_dir).select("rec_no", "url", F.when(F.col("reason").isNull(), "ok").otherwise("rejected").alias("status"), "reason")


def gate_counts(spark, sf_dir):
    return _gated(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def norm_line(spark, sf_dir):
    lines = records(spark, sf_dir, "lang").select("rec_no", "lang", F.posexplode(F.split("content", "\n", -1)).alias("pos", "line"))
    return lines.select("rec_no", "pos", normalize.norm_line(F.col("line"), F.coalesce("lang", F.lit("en"))).alias("line"))


def noise_blocks(spark, sf_dir):
    lines = normalize.drop_noise_blocks(F.split("content", "\n", -1))
    return records(spark, sf_dir).select("rec_no", F.array_join(lines, "\n").alias("content"))


def blank_collapse(spark, sf_dir):
    return records(spark, sf_dir).select("rec_no", F.array_join(normalize.collapse_blanks(F.split("content", "\n", -1)), "\n").alias("content"))


def assemble_paragraphs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", normalize.assemble(F.col("url"), F.col("title"), F.col("text"), F.col("subdomain"), F.array(F.col("url")), F.coalesce("lang", F.lit("en"))).alias("a"))
    return docs.select("doc_id", "a.content", "a.missing_notes", F.col("a.images_count").cast("bigint").alias("images_count"))


# extraction


def _pages(spark, sf_dir) -> DataFrame:
    """Every record as a page: its title as heading, its lines as sections, its data as JSON-LD."""
    rows = records(spark, sf_dir, "url", "title").where("url IS NOT NULL")
    section = lambda name, pattern: F.concat(F.lit(f'<div class="card-{name}"><p>'), escape_html(F.regexp_extract("content", pattern, 1)), F.lit("</div>"))
    data = F.to_json(F.struct(F.lit("Recipe").alias("@type"), F.col("title").alias("name"), F.split("content", "\n", -1).alias("recipeInstructions")))
    ld = F.concat(F.lit('<script type="application/ld+json">'), F.replace(data, F.lit("</"), F.lit("<\\/")), F.lit("</script>"))
    html = F.concat(
        F.lit("<html><head>"), ld, F.lit("</head><body><h1>"), escape_html(F.coalesce("title", F.lit(""))), F.lit('</h1><a href="/next/'), F.col("rec_no").cast("string"), F.lit('">next</a><a href="#top">top</a>'),
        F.coalesce(section("ingredients", r"(?s)Ingredients:\n(.*?)\nInstructions:"), F.lit("")), F.coalesce(section("steps", r"(?s)Instructions:\n(.*?)(?:\nNotes:|$)"), F.lit("")),
        F.lit('<article><img data-src="https://img.example/'), F.col("rec_no").cast("string"), F.lit('.jpg"></article></body></html>'),
    )
    return rows.select("rec_no", "url", "title", html.alias("html"))


SELECTORS = {"title": "h1", "ingredients": ".card-ingredients", "instructions": {"any": [".card-steps"]}, "image": ["article"]}


def page_title_h1(spark, sf_dir):
    raw = extract.raw_fields(_pages(spark, sf_dir), "rec_no", "html", SELECTORS)
    return raw.select("rec_no", "page.title")


def image_urls(spark, sf_dir):
    raw = extract.raw_fields(_pages(spark, sf_dir), "rec_no", "html", SELECTORS)
    return raw.select("rec_no", F.explode("page.images").alias("image"))


def jsonld_recipe(spark, sf_dir):
    raw = extract.raw_fields(_pages(spark, sf_dir), "rec_no", "html", SELECTORS)
    return raw.select("rec_no", "ld.title", F.length("ld.instructions").cast("bigint").alias("instructions_length"))


def page_links(spark, sf_dir):
    return extract.links(_pages(spark, sf_dir), "rec_no", "html").select("rec_no", "href")


def extract_article(spark, sf_dir):
    pages = _pages(spark, sf_dir).groupBy("url").agg(F.max("html").alias("html"))
    made = extract.articles(pages, "url", "html", SELECTORS, {"type": "Recipe/HowTo", "delivery_version": "V1.0", "collector": "joy"}, "2025-01-01", "2025-01-01T00:00")
    return made.select("url", "reason", "record.id", "record.text", "record.meta.data_info.title")


def _shaped_pages(spark, sf_dir) -> DataFrame:
    """Every record as a page of one of four shapes, by its number: sections beside a recipe object, a recipe in a graph alone, sections and metadata alone, a recipe of nested steps."""
    rows = records(spark, sf_dir, "title")
    shape, no = F.pmod("rec_no", F.lit(4)), F.col("rec_no").cast("string")
    section = lambda name, pattern: F.coalesce(F.concat(F.lit(f'<div class="card-{name}"><p>'), escape_html(F.regexp_extract("content", pattern, 1)), F.lit("</div>")), F.lit(""))
    sections = F.concat(section("ingredients", r"(?s)Ingredients:\n(.*?)\nInstructions:"), section("steps", r"(?s)Instructions:\n(.*?)(?:\nNotes:|$)"))
    lines = F.split("content", "\n", -1)
    plain = F.struct(F.lit("Recipe").alias("@type"), F.col("title").alias("name"), lines.alias("recipeInstructions"))
    picture = F.struct(F.concat(F.lit("https://img.example/ld/"), no, F.lit(".jpg")).alias("url"))
    graph = F.struct(F.array(F.struct(F.array(F.lit("Thing"), F.lit("recipe")).alias("@type"), F.col("title").alias("name"), picture.alias("image"), lines.alias("recipeInstructions"))).alias("@graph"))
    nested = F.array(F.struct(F.col("title").alias("name"), F.transform(lines, lambda x: F.struct(x.alias("text"))).alias("itemListElement")))
    data = F.when(shape == 0, F.to_json(plain)).when(shape == 1, F.to_json(graph)).when(shape == 3, F.to_json(F.struct(F.lit("Recipe").alias("@type"), F.col("title").alias("name"), nested.alias("recipeInstructions"))))
    ld = F.coalesce(F.concat(F.lit('<script type="application/ld+json">'), F.replace(data, F.lit("</"), F.lit("<\\/")), F.lit("</script>")), F.lit(""))
    meta = F.when(shape == 2, F.concat(F.lit('<meta property="og:image" content="https://img.example/og/'), no, F.lit('.jpg">'))).otherwise("")
    shown = F.when(shape == 0, F.concat(F.lit('<img data-src="https://img.example/'), no, F.lit('.jpg">'))).when(shape == 3, F.concat(F.lit('<source srcset="https://img.example/set/'), no, F.lit('.jpg 1x, https://img.example/other.jpg 2x">'))).otherwise("")
    html = F.concat(F.lit("<html><head>"), ld, meta, F.lit("</head><body><h1>"), escape_html(F.coalesce("title", F.lit(""))), F.lit("</h1>"), F.when(shape == 1, "").otherwise(sections), F.lit("<article>"), shown, F.lit("</article></body></html>"))
    return rows.select("rec_no", html.alias("html"))


def article_shapes(spark, sf_dir):
    pages = _shaped_pages(spark, sf_dir).select(F.concat(F.lit("https://p.example/"), F.col("rec_no").cast("string")).alias("url"), "html")
    made = extract.articles(pages, "url", "html", SELECTORS, {"type": "Recipe/HowTo", "delivery_version": "V1.0", "collector": "joy"}, "2025-01-01", "2025-01-01T00:00")
    return made.select("url", "reason", "record.id", "record.text", "record.meta.data_info.title", "record.meta.data_info.content", F.col("record.meta.collected_time").alias("collected_time"))


def extract_parts(spark, sf_dir):
    got = extract.parts(_pages(spark, sf_dir).groupBy("url").agg(F.max("html").alias("html")), "url", "html", SELECTORS)
    return got.select("url", "title", extract.fragment_text(F.col("ingredients_html")).alias("ingredients"), F.size("step_images").alias("step_images"))


def strip_ui_headers(spark, sf_dir):
    return records(spark, sf_dir).select("rec_no", extract.strip_ui_headers(F.col("content")).alias("content"))


def sitemap_walk(spark, sf_dir):
    """Sitemaps of all sites in two levels, each also naming its root again, walked to their pages."""
    rows = records(spark, sf_dir, "url").where("url IS NOT NULL").select(urls.host_of(F.col("url")).alias("domain"), F.trim("url").alias("url")).where("domain IS NOT NULL").distinct()
    roots = rows.select("domain").distinct().select(urls.sitemap_root(F.col("domain"), F.lit(None).cast("string")).alias("url"), "domain")
    leaf = F.concat(F.lit("https://"), "domain", F.lit("/part-"), F.pmod(F.xxhash64("url"), F.lit(16)).cast("string"), F.lit(".xml"))
    filled = rows.select(leaf.alias("leaf"), "domain", "url").groupBy("leaf").agg(F.first("domain").alias("domain"), F.concat_ws("", F.collect_set(F.concat(F.lit("<url><loc> "), escape_html(F.col("url")), F.lit("</loc></url>")))).alias("x"))
    xml = lambda head, body: F.concat(F.lit(f'<?xml version="1.0"?><{head} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), body, F.lit(f"</{head}>"))
    leaves = filled.select(F.col("leaf").alias("url"), xml("urlset", F.col("x")).alias("xml"))
    again = F.concat(F.lit("<sitemap><loc>https://"), "domain", F.lit("/sitemap.xml</loc></sitemap>"))
    tops = filled.groupBy("domain").agg(F.concat_ws("", F.collect_list(F.concat(F.lit("<sitemap><loc>"), "leaf", F.lit("</loc></sitemap>")))).alias("x"))
    tops = tops.select(urls.sitemap_root(F.col("domain"), F.lit(None).cast("string")).alias("url"), xml("sitemapindex", F.concat("x", again)).alias("xml"))
    return urls.walk_sitemaps(roots, extract.sitemap_links(leaves.unionByName(tops), "url", "xml"))


# validation


def _checked(spark, sf_dir) -> DataFrame:
    return validate.from_table(table(spark, sf_dir, "example_clean").select("path", "line", "id", "text", "meta"))


def v_findings(spark, sf_dir):
    return validate.findings(validate.with_findings(_checked(spark, sf_dir))).select("path", "line", "tag", "msg")


def v_findings_native(spark, sf_dir):
    return v_findings(spark, sf_dir).where(~F.col("msg").startswith("检出未被"))


def v_findings_by_tag(spark, sf_dir):
    return v_findings(spark, sf_dir).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def v_summary(spark, sf_dir):
    return validate.summary(validate.with_findings(_checked(spark, sf_dir)))


def v_first_noise_keyword(spark, sf_dir):
    return records(spark, sf_dir).select("rec_no", validate.noise_keyword(F.col("content")).alias("keyword"))


def v_bare_image_url(spark, sf_dir):
    return records(spark, sf_dir).select("rec_no", F.explode(validate.bare_image_urls(F.col("content"))).alias("url"))


def v_unprotected_math(spark, sf_dir):
    return records(spark, sf_dir).where("content IS NOT NULL").select("rec_no", validate.unprotected_math(F.col("content")).alias("unprotected"))


def v_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "example_clean").select("rec_no", F.col("meta.data_info.processing_date").alias("d"), F.col("meta.collected_time").alias("t"))
    return rows.select("rec_no", validate.is_date(F.col("d")).alias("date_ok"), validate.is_minute(F.col("t")).alias("time_ok"))


def v_json_status(spark, sf_dir):
    return validate.from_lines(table(spark, sf_dir, "raw_line")).groupBy("path", "status").agg(F.count(F.lit(1)).alias("n"))


def v_line_findings(spark, sf_dir):
    return validate.findings(validate.with_findings(validate.from_lines(table(spark, sf_dir, "raw_line")))).select("path", "line", "tag", "msg")


def v_line_rules(spark, sf_dir):
    """Findings of JSON lines, the parser's own words left out of its messages."""
    return v_line_findings(spark, sf_dir).select("path", "line", "tag", F.regexp_replace("msg", "^(JSON 解析失败：).*$", "$1").alias("msg"))


def v_dup_url(spark, sf_dir):
    return validate.duplicate_urls(_checked(spark, sf_dir))


def v_dup_id(spark, sf_dir):
    return validate.duplicate_ids(_checked(spark, sf_dir))


def v_short_files(spark, sf_dir):
    paths = table(spark, sf_dir, "file_summary").select("path")
    return validate.short_files(paths, _checked(spark, sf_dir), 100)


def finding_counts(spark, sf_dir):
    found = table(spark, sf_dir, "finding").select("path", F.upper("tag").alias("tag"))
    return found.groupBy("path", "tag").agg(F.count(F.lit(1)).alias("n"))


def reject_reasons(spark, sf_dir):
    return table(spark, sf_dir, "rejected").groupBy(F.lower("reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("urls"))


def pass_rates(spark, sf_dir):
    rows = table(spark, sf_dir, "file_summary")
    return rows.select("path", F.when(F.col("total") > 0, F.col("passed") / F.col("total") * 100).otherwise(F.lit(0.0)).alias("pass_rate"))


# volumes, reports, previews


def merge_volumes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return volumes.merge_volumes(lines, ["l_orderkey"], ["l_linenumber", "l_quantity", "l_shipdate"])


def merge_volume_sizes(spark, sf_dir):
    return volumes.volume_sizes(merge_volumes(spark, sf_dir))


def rolling_parts(spark, sf_dir):
    return sinks.rolling(table(spark, sf_dir, "example_clean").select("path", "line"), ["path"], ["line"], 400).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("idx").alias("last_idx"))


def rejected_json(spark, sf_dir):
    rows = table(spark, sf_dir, "rejected")
    return rows.select(sinks.rejected_line(F.col("url"), F.col("reason")).alias("value"))


def report_lines(spark, sf_dir):
    found = validate.judged_once(_checked(spark, sf_dir))
    return sinks.report_lines(validate.findings(found), validate.summary(found), "2025-01-01T00:00:00Z").select("path", "text")


def report_overall(spark, sf_dir):
    found = validate.judged_once(_checked(spark, sf_dir))
    every = validate.findings(found).select("path", "line", "tag", "msg").unionByName(validate.duplicate_urls(found)).unionByName(validate.duplicate_ids(found))
    return sinks.overall_report(every, validate.summary(found), "2025-01-01T00:00:00Z").select("text")


def preview_blocks(spark, sf_dir):
    blocks = records(spark, sf_dir).select("rec_no", F.posexplode(preview.content_lines(F.col("content"))).alias("pos", "b"))
    return blocks.select("rec_no", "pos", "b.kind", "b.value")


def preview_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "example_clean")
    card = preview.card(F.col("line"), F.col("id"), F.col("meta.data_info.title"), preview.pretty_json(F.to_json("meta")), F.col("meta.data_info.content"))
    return preview.pages(rows.select("path", "line", card.alias("card"))).select("path", "page", F.length("html").alias("html_length"))


def preview_html(spark, sf_dir):
    """Pages of cards without the indented JSON, whole."""
    rows = table(spark, sf_dir, "example_clean")
    card = preview.card(F.col("line"), F.col("id"), F.col("meta.data_info.title"), F.lit(None).cast("string"), F.col("meta.data_info.content"), error=F.when(F.col("meta.data_info.url").isNull(), F.lit("no <url>")), raw=F.col("id"))
    return preview.pages(rows.select("path", "line", card.alias("card")), per_page=40)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        record_id, url_normalize, url_normalize_dedup, url_allow_deny, url_rule_semi_anti, frontier_union, fetch_left_join, links_first_seen, links_absolute, links_discovered, seen_urls, limit_sorted,
        build_content, gate_split, gate_counts, norm_line, noise_blocks, blank_collapse, assemble_paragraphs,
        page_title_h1, image_urls, jsonld_recipe, page_links, extract_article, article_shapes, extract_parts, strip_ui_headers, sitemap_walk,
        v_findings, v_findings_native, v_findings_by_tag, v_summary, v_first_noise_keyword, v_bare_image_url, v_unprotected_math, v_dates, v_json_status, v_line_findings, v_line_rules, v_dup_url, v_dup_id, v_short_files,
        finding_counts, reject_reasons, pass_rates, merge_volumes, merge_volume_sizes, rolling_parts, rejected_json, report_lines, report_overall, preview_blocks, preview_pages, preview_html,
    ]
    steps = {
        "clean_translate": over_content(clean.narrow_punctuation), "clean_tags_entities": over_content(clean.drop_tags_and_entities), "clean_symbols": over_content(clean.ascii_symbols),
        "clean_emoji": over_content(clean.drop_decoration), "clean_noise": over_content(clean.drop_noise), "clean_lines": over_content(clean.tidy_lines), "clean_full": over_content(clean.clean_text),
        "math_guard": over_content(normalize.math_guard), "mask_pii": over_documents(normalize.mask_pii),
    }
    return {f.__name__: f for f in own} | steps


def oracle_sql() -> dict[str, str]:
    return ORACLES
