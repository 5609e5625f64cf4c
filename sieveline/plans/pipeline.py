"""The four tools as functions: scrape, validate, merge, preview."""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, extract, preview as render, urls, validate as rules, volumes
from ..session import checkpoint, ship
from ..sources import http, jsonl, sinks
from ..sources.config import SiteConfig, load_configs


# The lines that a run tells.
FOUND_CONFIGS = "[BATCH] Found {n} site configs in: {configs}"
DISCOVERED = "[DISCOVER_DONE] {site} total_urls={n}"
SITE_DONE = "[DONE {time}] site={run.site} ok={run.accepted} rejected={run.rejected} out_dir={out}"
SITE_FAILED = "[ERROR] {run.site}: {run.error}"
ALL_DONE = "[BATCH DONE {time}] sites={n} total_ok={ok} total_rejected={rejected} out_dir={out}"
RATE = "[SUMMARY] total={r.total} passed={r.passed} pass_rate={r.pass_rate:.2f}%"
PREVIEWED = "Preview written to: {path}"


@dataclass
class Validation:
    findings: DataFrame
    summary: DataFrame


def discover(spark: SparkSession, config: SiteConfig, pages: DataFrame, sitemaps: DataFrame | None = None, max_pages: int = 1) -> DataFrame:
    """The frontier of one site from ``pages`` (``url, html``) and ``sitemaps`` (``url, sitemaps, pages``)."""
    index = spark.createDataFrame([(u,) for u in config.index_pages], "page string")
    edges = extract.next_pages(pages, "url", "html").withColumnRenamed("url", "page")
    steps = urls.follow(index, edges, max(1, max_pages)).join(pages.withColumnRenamed("url", "page"), "page")
    first = extract.links(steps.where("step = 1"), "page", "html")
    later = extract.links(steps.where("step > 1"), "page", "html", first=False)
    found = first.unionByName(later).select(F.col("href").alias("url"))
    if config.sitemap and sitemaps is not None:
        root = config.sitemap_url or f"https://{config.domain}/sitemap.xml"
        found = urls.frontier(found, urls.walk_sitemaps(spark.createDataFrame([(root,)], "url string"), sitemaps))
    return found.where(urls.url_allowed(F.col("url"), config.allow, config.deny)).distinct()


def discover_entries(entries: list[str], pages: DataFrame, prefixes: list[str], blocked: list[str], max_pages: int = 1) -> DataFrame:
    """``url, entry, pos``: allowed links of the first ``max_pages`` entry pages that were fetched, each where it is seen first."""
    spark = pages.sparkSession
    wanted = spark.createDataFrame([(i, u) for i, u in enumerate(entries[:max_pages])], "entry int, url string")
    opened = wanted.join(pages.select("url", "html").where("html IS NOT NULL"), "url")
    anchors = extract.links(opened, "entry", "html", first=False).join(wanted.withColumnRenamed("url", "base"), "entry")
    return urls.discovered(anchors, prefixes, blocked)


def scrape(spark: SparkSession, config: SiteConfig, frontier: DataFrame, pages: DataFrame, run_date: str, run_time: str, min_chars: int = 220, max_articles: int = 200) -> tuple[DataFrame, DataFrame]:
    """Accepted records and rejected ``url, reason``; pages that weren't fetched are rejected as such."""
    wanted = clean.limit_articles(frontier.select("url").distinct(), "url", max_articles)
    fetched = wanted.join(pages.select("url", "html"), "url", "left")
    meta = {"source": config.domain, **config.meta}
    made = extract.articles(fetched, "url", "html", config.selectors, meta, run_date, run_time, min_chars)
    return clean.split_by_reason(made)[0].select("record.*"), made.where("reason IS NOT NULL").select("url", "reason")


@dataclass
class SiteRun:
    """What a run did for one site: where its files are, or why there are none."""

    site: str
    accepted: int = 0
    rejected: int = 0
    error: str | None = None


def run_sites(
    spark: SparkSession, configs: str, out: str, run_date: str, run_time: str, pages: DataFrame | None = None, sitemaps: DataFrame | None = None,
    min_chars: int = 220, max_pages: int = 1, max_articles: int = 200, say: Callable[[str], None] = print, **fetching,
) -> list[SiteRun]:
    """Every configuration of a file or folder: discovery, scraping, ``<site>.clean.jsonl`` and ``<site>.rejected.jsonl`` under ``out``.

    ``pages`` (``url, html``) are pages at hand; without them the frontier is
    fetched (``fetching``: parameters of ``http.fetched``). A site that fails is
    told as such and stops no other; so is a configuration that doesn't load.
    """
    ship(spark)
    good, bad = load_configs(configs)
    say(FOUND_CONFIGS.format(n=len(good) + len(bad), configs=configs))
    runs = [SiteRun(name, error=error) for name, error in bad]
    for run in runs:
        say(SITE_FAILED.format(run=run))
    for config in good:
        run = SiteRun(config.domain)
        runs.append(run)
        try:
            held = pages
            if held is None:
                index = spark.createDataFrame([(u,) for u in config.index_pages], "url string")
                held = checkpoint(http.fetched(index, **fetching).select("url", "html"))
            frontier = checkpoint(discover(spark, config, held, sitemaps, max_pages))
            say(DISCOVERED.format(site=config.domain, n=frontier.count()))
            wanted = clean.limit_articles(frontier, "url", max_articles)
            texts = pages if pages is not None else checkpoint(http.fetched(wanted, **fetching).select("url", "html"))
            accepted, rejected = scrape(spark, config, frontier, texts, run_date, run_time, min_chars, max_articles)
            accepted, rejected = checkpoint(accepted), checkpoint(rejected)
            lines = accepted.select(F.lit(f"{config.domain}.clean.jsonl").alias("name"), F.col("meta.data_info.url").alias("url"), sinks.json_line(F.struct("*")).alias("value"))
            lines = lines.unionByName(rejected.select(F.lit(f"{config.domain}.rejected.jsonl").alias("name"), "url", sinks.rejected_line(F.col("url"), F.col("reason")).alias("value")))
            sinks.write_named(lines, "name", ["url"], "value", out, always=(f"{config.domain}.clean.jsonl", f"{config.domain}.rejected.jsonl"))
            run.accepted, run.rejected = accepted.count(), rejected.count()
            say(SITE_DONE.format(time=run_time, run=run, out=out))
        except Exception as e:  # noqa: BLE001 - one site must not stop the others
            run.error = f"{type(e).__name__}: {e}"
            say(SITE_FAILED.format(run=run))
    say(ALL_DONE.format(time=run_time, n=len(runs), ok=sum(r.accepted for r in runs), rejected=sum(r.rejected for r in runs), out=out))
    return runs


def validate(spark: SparkSession, inputs: list[str] | str, strict: bool = False, policy: rules.Policy | None = None) -> Validation:
    """Findings and rates of the files that the inputs name; files that aren't UTF-8 get one finding and no lines."""
    paths = jsonl.expand_paths(inputs, spark)
    every_line = jsonl.read_lines(spark, paths)
    broken = rules.unreadable_files(checkpoint(jsonl.not_utf8(every_line)))  # a name for each broken file
    checked = rules.from_lines(every_line.join(broken.select("path"), "path", "left_anti"))
    found = rules.judged_once(checked, policy)  # lines are parsed and judged once
    no_order = lambda df: df.withColumn("ord", F.lit(None).cast("int")).select("path", "line", "ord", "tag", "msg")
    every = rules.findings(found).unionByName(no_order(broken)).unionByName(no_order(rules.duplicate_urls(found))).unionByName(no_order(rules.duplicate_ids(found)))
    if strict:
        names = spark.createDataFrame([(p,) for p in paths], "path string")
        every = every.unionByName(no_order(rules.short_files(names, found)))
    return Validation(every, rules.summary(found))


def reports(result: Validation, run_time: str) -> tuple[DataFrame, DataFrame]:
    """Lines of the report of each file, and of the one over all; repeated ids are in the latter only."""
    own = result.findings.where("tag <> 'DUP_ID'")
    return sinks.report_lines(own, result.summary, run_time), sinks.overall_report(result.findings, result.summary, run_time)


def write_reports(result: Validation, run_time: str, out: str | None = None, say: Callable[[str], None] = print) -> list[str]:
    """``<file>.report.txt`` beside each file, or under ``out`` by their names; ``ALL.report.txt`` where there are several files; tells the rate."""
    spark = result.summary.sparkSession
    each, overall = reports(result, run_time)
    paths = [r.path for r in result.summary.where("path IS NOT NULL").select("path").orderBy("path").collect()]  # names of files, no lines
    report = F.concat(F.regexp_replace("path", r"\.[^./]*$", ""), F.lit(".report.txt"))
    root = out or (os.path.commonpath(paths) if len(paths) > 1 else os.path.dirname(paths[0]) if paths else ".")
    if paths and root in paths:
        root = os.path.dirname(root)
    inner = F.substring(report, len(root.rstrip("/")) + 2, 4096) if out is None else F.regexp_extract(report, r"([^/]*)$", 1)
    written = sinks.write_named(each.select(inner.alias("name"), "seq", "text"), "name", ["seq", "text"], "text", root)
    if len(paths) > 1:
        written += sinks.write_named(overall.withColumn("name", F.lit("ALL.report.txt")), "name", ["path", "line", "seq", "text"], "text", root)
    total = result.summary.where("path IS NULL").first()
    if total and total.total:
        say(RATE.format(r=total))
    return [os.path.join(root, x) for x in written]


def merge(spark: SparkSession, inputs: str, out: str, min_lines: int = volumes.MIN_LINES, soft_max: int = volumes.SOFT_MAX, day: str | None = None) -> DataFrame:
    """Lines of all files in order into ``<day>_clean_file_<n>.jsonl`` under ``out``; returns ``volume, lines``. Inputs without a line give one empty volume."""
    merged = volumes.merge_volumes(jsonl.read_lines(spark, jsonl.expand_paths(inputs, spark)), ["path"], ["line"], soft_max, min_lines)
    sinks.write_volumes(merged, "value", out, day or datetime.date.today().strftime("%Y%m%d"))
    return volumes.volume_sizes(merged)


def preview(spark: SparkSession, inputs: list[str] | str, per_page: int = 1000) -> DataFrame:
    """``path, page, html`` of the files that the inputs name."""
    ship(spark)
    lines = jsonl.tolerant(jsonl.read_lines(spark, jsonl.expand_paths(inputs, spark)))
    get = lambda p: F.get_json_object("value", p)
    card = render.card(F.col("line"), get("$.id"), get("$.meta.data_info.title"), render.pretty_json(get("$.meta")), get("$.meta.data_info.content"), render.other_members(F.col("value")), F.col("error"), F.col("value"))
    return render.pages(lines.select("path", "line", card.alias("card")), per_page=per_page)


def write_previews(spark: SparkSession, inputs: list[str] | str, out: str | None = None, per_page: int = 1000, say: Callable[[str], None] = print) -> list[str]:
    """Pages as files: ``out`` itself where it names a file and there is one input, else ``preview_<file>.html`` under it or under ``deliveries_pre_check/<folder>``; later pages get their number."""
    paths = jsonl.expand_paths(inputs, spark)
    made = preview(spark, paths, per_page)
    single = out is not None and len(paths) == 1 and not os.path.isdir(out) and not out.endswith("/")
    folder = (os.path.dirname(out) or ".") if single else out or "deliveries_pre_check"
    name = F.lit(os.path.basename(out)) if single else F.regexp_extract(render.preview_name(F.col("path")), r"([^/]*)$", 1) if out else render.preview_name(F.col("path"))
    numbered = F.when(F.col("page") == 0, name).otherwise(F.concat(F.regexp_replace(name, r"\.html$", ""), F.lit("."), (F.col("page") + 1).cast("string"), F.lit(".html")))
    written = [os.path.join(folder, x) for x in sinks.write_named(made.select(numbered.alias("name"), "html"), "name", [], "html", folder)]
    for x in written:
        say(PREVIEWED.format(path=x))
    return written
