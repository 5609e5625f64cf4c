"""Records as HTML cards and pages."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import escape_html, let, plines, pstrip

# What stands where there is nothing to show.
NO_TITLE = "<h2 class='title missing'>（无标题）</h2>"
NO_CONTENT, NOTHING_SHOWN = "<div class='content-empty'>（无内容）</div>", "<div class='content-empty'>（无渲染内容）</div>"


def content_lines(content: Column) -> Column:
    """``array<struct<kind, value>>`` of each line: blank, image (its address), heading, or text.

    Text keeps its outer blanks; an image line whose address is no web address
    is text without them. Null content has no lines.
    """

    def one(line: Column) -> Column:
        bare = pstrip(line)
        pictured = bare.startswith("[Image:")
        address = F.btrim(pstrip(F.substr(bare, F.lit(8))), F.lit(" ]"))
        kind = (
            F.when(bare == "", "blank")
            .when(pictured & F.lower(address).rlike(r"^https?://"), "image")
            .when(bare.startswith("## "), "heading")
            .otherwise("text")
        )
        value = F.when(kind == "image", address).when(kind == "heading", pstrip(F.substr(bare, F.lit(4)))).when(pictured | (kind == "blank"), bare).otherwise(line)
        return F.struct(kind.alias("kind"), value.alias("value"))

    return F.transform(plines(content), one)


def render_content(content: Column) -> Column:
    """Images, headings, and paragraphs of the text lines between them."""
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def flush(s: Column) -> Column:
        return F.when(s["open"] == "", s["done"]).otherwise(F.array_append(s["done"], F.concat(F.lit("<p>"), s["open"], F.lit("</p>"))))

    def step(s: Column, x: Column) -> Column:
        value = escape_html(x["value"])
        picture = F.concat(
            F.lit("<div class='img-line'><div class='img-box'><img src='"), value, F.lit("' alt='image' loading='lazy'></div><div class='img-url'>"), value, F.lit("</div></div>"),
        )
        block = F.when(x["kind"] == "image", picture).when(x["kind"] == "heading", F.concat(F.lit("<h3>"), value, F.lit("</h3>")))
        grown = F.when(s["open"] == "", value).otherwise(F.concat(s["open"], F.lit("<br>"), value))
        text = x["kind"] == "text"
        closed = F.when(block.isNull(), flush(s)).otherwise(F.array_append(flush(s), block))
        return F.struct(F.when(text, s["done"]).otherwise(closed).alias("done"), F.when(text, grown).otherwise("").alias("open"))

    blocks = F.aggregate(F.coalesce(content_lines(content), F.array().cast("array<struct<kind:string,value:string>>")), state, step, flush)
    body = let(blocks, lambda b: F.when(F.size(b) == 0, F.lit(NOTHING_SHOWN)).otherwise(F.array_join(b, "\n")))
    return F.when(content.isNull(), F.lit(NO_CONTENT)).otherwise(body)


def render_title(title: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) == "", F.lit(NO_TITLE)).otherwise(F.concat(F.lit("<h2 class='title'>"), escape_html(title), F.lit("</h2>")))


@F.pandas_udf(StringType())
def pretty_json(values):
    """JSON text with an indent of two, characters kept; what doesn't parse comes back as it is."""

    def one(value):
        try:
            return json.dumps(json.loads(value), ensure_ascii=False, indent=2)
        except ValueError:
            return value

    return values.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def other_members(values):
    """The members of a JSON object beside id, meta and text, as indented JSON; null where there are none."""

    def one(value):
        try:
            record = json.loads(value)
        except ValueError:
            return None
        rest = {k: v for k, v in record.items() if k not in ("id", "meta", "text")} if isinstance(record, dict) else {}
        return json.dumps(rest, ensure_ascii=False, indent=2) if rest else None

    return values.map(one, na_action="ignore")


def card(index: Column, id_: Column, title: Column, meta_json: Column, content: Column, others_json: Column | None = None, error: Column | None = None, raw: Column | None = None) -> Column:
    """One record: number, id, metadata, a note for the text, other members, then title and content; or its parse error with the raw line."""
    shown = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f'<details class="{name}" open><summary>{name}</summary><pre>'), escape_html(value), F.lit("</pre></details>"))).otherwise("")
    number = F.concat(F.lit('<section class="card"><p class="index">#'), index.cast("string"), F.lit("</p>"))
    body = F.concat(
        number, F.lit("<code>"), escape_html(F.coalesce(id_, F.lit(""))), F.lit("</code>"), shown("meta", meta_json), F.lit('<p class="text">见下方渲染</p>'),
        shown("others", others_json) if others_json is not None else F.lit(""), render_title(title), render_content(content), F.lit("</section>"),
    )
    if error is None:
        return body
    return F.when(error.isNotNull(), F.concat(number, F.lit("<p>解析错误</p>"), shown("error", error), shown("raw", raw if raw is not None else F.lit("")), F.lit("</section>"))).otherwise(body)


def pages(cards: DataFrame, path: str = "path", line: str = "line", card_col: str = "card", per_page: int = 1000) -> DataFrame:
    """``path, page, html``: cards in order, ``per_page`` on each page, so that no file becomes one row of any size."""
    numbered = cards.withColumn("_page", F.floor((F.col(line) - 1) / per_page).cast("int"))
    grouped = numbered.groupBy(path, "_page").agg(F.sort_array(F.collect_list(F.struct(line, card_col))).alias("_cards"))
    body = F.array_join(F.transform("_cards", lambda c: c[card_col]), "\n")
    html = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), escape_html(F.col(path)), F.lit("</title></head><body><h1>"), escape_html(F.col(path)), F.lit(" ("), F.size("_cards").cast("string"), F.lit(")</h1>"), body, F.lit("</body></html>"))
    return grouped.select(F.col(path).alias("path"), F.col("_page").alias("page"), html.alias("html"))


def preview_name(path: Column) -> Column:
    """``<parent>/preview_<stem>.html``."""
    parent = F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?:\.clean)?\.jsonl$", "")
    return F.concat(F.when(parent != "", F.concat(parent, F.lit("/"))).otherwise(""), F.lit("preview_"), stem, F.lit(".html"))


def output_path(path: str, out: str | None = None, many: bool = False) -> str:
    """Where the page of one file goes: ``out`` itself if it names a file and there is one input, else under a folder."""
    stem = os.path.basename(path)
    for end in (".clean.jsonl", ".jsonl"):
        if stem.endswith(end):
            stem = stem[: -len(end)]
            break
    name = f"preview_{stem}.html"
    if out and not many and out.endswith(".html"):
        return out
    folder = out or os.path.join("deliveries_pre_check", os.path.basename(os.path.dirname(os.path.abspath(path))))
    return os.path.join(folder, name)


