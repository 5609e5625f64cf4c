"""Pages to records: selected text, images, JSON-LD recipes, parts, links.

Python sees each page once, in an Arrow function that returns all raw fields;
cleaning and assembly are Columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import Node, SelectorError, parse, select, select_all
from ..functions.text import pstrip, rx
from ..sources.arrow import arrow_flat_map
from .clean import build_content, clean_text, record_id, reject_reason

IMAGE_FALLBACK = ".wprm-recipe, .tasty-recipe, article, main"
UI_HEADER = rx(r"^\s*(?:ingredients & substitutes|ingredients|instructions|notes)\b.*?$", ignore_case=True, multiline=True)
FIELDS = "title string, images array<string>, ingredients string, instructions string, notes string"


def selectors_of(value) -> list[str]:
    """A selector value as a list: a string, a list, or a mapping with ``any`` or ``all``, which mean the same."""
    if isinstance(value, str):
        return [value] if value.strip() else []
    if isinstance(value, dict):
        value = value.get("any") or value.get("all") or []
    return [v for v in value if isinstance(v, str) and v.strip()] if isinstance(value, (list, tuple)) else []


def first_text(root: Node, selectors: list[str]) -> str:
    return next((t for t in map(text_or_none, select_all(root, selectors)) if t), "")


def text_or_none(node: Node | None) -> str | None:
    """The text of a node that is there and has some."""
    return (node.text(" ") or None) if node is not None else None


def joined_texts(root: Node, selectors: list[str]) -> str:
    return "\n".join(t for t in (n.text("\n") for n in select_all(root, selectors)) if t)


def unique(values: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(values))


def image_urls(root: Node, selectors: list[str]) -> list[str]:
    """Of images inside the selected nodes, then of their sources; the page's own metadata where there are none."""
    urls = []
    for node in select_all(root, selectors):
        urls += [n.attrs.get("data-src") or n.attrs.get("src") or "" for n in select(node, "img")]
        urls += [n.attrs["srcset"].split(",")[0].split()[0] for n in select(node, "source[srcset]") if n.attrs["srcset"].split(",")[0].split()]
    urls = [u.strip() for u in urls if u.strip().startswith("http")]
    if not urls:
        for s in ('meta[property="og:image"]', 'meta[name="twitter:image"]'):
            urls += [u for u in (n.attrs.get("content", "").strip() for n in select(root, s)) if u.startswith("http")]
    return unique(urls)


def as_list(value) -> list:
    return [] if value is None else value if isinstance(value, list) else [value]


def spoken(thing) -> str:
    """What a JSON-LD value says: a string itself, an object by its text or else its name, in whatever type these are given."""
    said = thing if isinstance(thing, str) else (thing.get("text") or thing.get("name") or "") if isinstance(thing, dict) else ""
    return str(said).strip()


def steps_in(value, depth: int = 1) -> Iterator[str]:
    """Texts of instruction steps in their order; what an object lists below itself follows it, one level deep."""
    for thing in as_list(value):
        yield spoken(thing)
        if depth and isinstance(thing, dict) and thing.get("itemListElement"):
            yield from steps_in(thing["itemListElement"], depth - 1)


def addresses_in(value) -> Iterator[str]:
    """Web addresses of pictures given as strings or objects."""
    for thing in as_list(value):
        at = (thing.get("url") or thing.get("@id")) if isinstance(thing, dict) else thing
        if isinstance(at, str) and at.startswith("http"):
            yield at


def typed_objects(root: Node) -> Iterator[dict]:
    """The objects of a page's JSON-LD blocks, graphs opened; blocks that don't parse are passed over."""
    for script in select(root, 'script[type="application/ld+json"]'):
        try:
            data = json.loads("".join(c for c in script.children if isinstance(c, str)))
        except (ValueError, RecursionError):
            continue
        for thing in as_list(data):
            if isinstance(thing, dict):
                graph = thing.get("@graph")
                yield from (x for x in (graph if isinstance(graph, list) else [thing]) if isinstance(x, dict))


def jsonld_recipe(root: Node) -> tuple[str, list[str], str, str, str] | None:
    """Title, pictures, ingredients, instructions and (never given) notes of the first object typed as a recipe."""
    for thing in typed_objects(root):
        if any(isinstance(t, str) and t.lower() == "recipe" for t in as_list(thing.get("@type"))):
            lines = lambda texts: "\n".join(t for t in texts if t)
            return (
                str(thing.get("name") or "").strip(), unique(addresses_in(thing.get("image"))), lines(str(x).strip() for x in as_list(thing.get("recipeIngredient"))),
                lines(steps_in(thing.get("recipeInstructions"))), "",
            )
    return None


def raw_fields(pages: DataFrame, key: str, html: str, selectors: dict) -> DataFrame:
    """``key, error, page, ld``: fields by selectors and by JSON-LD; ``error`` names what failed, a missing page among it."""
    chosen = {k: selectors_of(selectors.get(k)) for k in ("title", "image", "ingredients", "instructions", "notes")}
    chosen["title"] = chosen["title"] or ["h1"]
    chosen["image"] = chosen["image"] or [IMAGE_FALLBACK]

    def make():
        def row(k, page):
            if page is None:
                yield k, "RuntimeError", None, None
                return
            try:
                root = parse(page)
                own = (first_text(root, chosen["title"]), image_urls(root, chosen["image"]), *(joined_texts(root, chosen[f]) for f in ("ingredients", "instructions", "notes")))
                ld = jsonld_recipe(root)
            except Exception as e:  # noqa: BLE001 - any failure of a page is its reject reason
                yield k, type(e).__name__, None, None
                return
            names = ("title", "images", "ingredients", "instructions", "notes")
            yield k, None, dict(zip(names, own)), dict(zip(names, ld)) if ld else None

        return row

    kind = pages.schema[key].dataType.simpleString()
    return arrow_flat_map(pages.select(key, html), make, f"`{key}` {kind}, error string, page struct<{FIELDS.replace(' ', ':').replace(',:', ', ')}>, ld struct<{FIELDS.replace(' ', ':').replace(',:', ', ')}>")


def strip_ui_headers(text: Column) -> Column:
    """Lines that begin with a section heading go whole."""
    return pstrip(F.regexp_replace(text, UI_HEADER, ""))


def articles(pages: DataFrame, url: str, html: str, selectors: dict, meta: dict, run_date: str, run_time: str, min_chars: int = 220) -> DataFrame:
    """``record, reason, url``: the delivery record of each page, or why there is none.

    Sections by selectors are cleaned; where sections are short or title or
    images are missing, JSON-LD fills what is lacking. The assembled content is
    cleaned again. Date and time of the run are parameters.
    """
    raw = raw_fields(pages, url, html, selectors)
    section = {f: clean_text(strip_ui_headers(F.coalesce(F.col(f"page.{f}"), F.lit("")))) for f in ("ingredients", "instructions", "notes")}
    raw = raw.select("*", *[c.alias(f"_{f}") for f, c in section.items()])
    lacking = (F.length("_ingredients") < 10) | (F.length("_instructions") < 10) | (F.coalesce("page.title", F.lit("")) == "") | (F.size("page.images") == 0)
    use = lacking & F.col("ld").isNotNull()
    filled = raw.select(
        url, "error",
        F.when(use & (F.col("page.title") == ""), F.col("ld.title")).otherwise(F.col("page.title")).alias("title"),
        F.when(use & (F.size("page.images") == 0), F.col("ld.images")).otherwise(F.col("page.images")).alias("images"),
        F.when(use & (F.length("_ingredients") < 10), clean_text(F.col("ld.ingredients"))).otherwise(F.col("_ingredients")).alias("ingredients"),
        F.when(use & (F.length("_instructions") < 10), clean_text(F.col("ld.instructions"))).otherwise(F.col("_instructions")).alias("instructions"),
        F.col("_notes").alias("notes"),
    )
    content = clean_text(build_content(F.get("images", F.lit(0)), F.col("ingredients"), F.col("instructions"), F.col("notes")))
    built = filled.withColumn("content", content).withColumn("text", pstrip(F.concat_ws("\n", "title", "content")))
    lit = lambda k: F.lit(meta.get(k))
    info = F.struct(
        F.lit("en").alias("lang"), F.col(url).alias("url"), lit("source").alias("source"), lit("type").alias("type"), F.lit(run_date).alias("processing_date"),
        lit("delivery_version").alias("delivery_version"), F.col("title"), F.col("content"),
    )
    record = F.struct(
        record_id(F.col(url)).alias("id"), F.col("text"),
        F.struct(info.alias("data_info"), F.struct(lit("domain").alias("domain"), lit("subdomain").alias("subdomain")).alias("content_info"), lit("collector").alias("collector"), F.lit(run_time).alias("collected_time")).alias("meta"),
    )
    reason = reject_reason(F.col("content"), F.col("text"), F.col("error"), min_chars)
    return built.select(F.col(url).alias("url"), reason.alias("reason"), F.when(reason.isNull(), record).alias("record"))


def links(pages: DataFrame, key: str, html: str, first: bool = True) -> DataFrame:
    """``key, pos, href``: hrefs of anchors as they stand, stripped. A first page also leaves out fragments, mail and script links."""

    def make():
        def row(k, page):
            for pos, node in enumerate(select(parse(page), "a[href]")):
                href = node.attrs["href"].strip()
                if href and not (first and href.startswith(("#", "mailto:", "javascript:"))):
                    yield k, pos, href

        return row

    kind = pages.schema[key].dataType.simpleString()
    return arrow_flat_map(pages.select(key, html), make, f"`{key}` {kind}, pos int, href string")


def next_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key, next``: the page that ``rel=next`` names."""

    def make():
        def row(k, page):
            root = parse(page)
            found = select(root, 'link[rel="next"]') + select(root, 'a[rel="next"]')
            href = next((n.attrs.get("href", "").strip() for n in found if n.attrs.get("href", "").strip()), None)
            if href:
                yield k, href

        return row

    kind = pages.schema[key].dataType.simpleString()
    return arrow_flat_map(pages.select(key, html), make, f"`{key}` {kind}, next string")


def sitemap_links(documents: DataFrame, url: str, xml: str) -> DataFrame:
    """``url, sitemaps, pages`` of sitemap documents; those that aren't XML are read by their ``loc`` tags, and ``sitemap`` in the address tells the kind."""
    safe = F.when(F.col(xml).rlike(r"(?s)^\s*<(?:\?xml.*?\?>\s*)?.*</\s*(?:\w+:)?(?:urlset|sitemapindex)\s*>\s*$"), F.regexp_replace(xml, r"(?s)^.*?(?=<(?:\w+:)?(?:urlset|sitemapindex))", ""))
    loc = lambda parent: F.transform(F.xpath(safe, F.lit(f"//*[local-name()='{parent}']/*[local-name()='loc']/text()")), pstrip)
    loose = F.transform(F.regexp_extract_all(xml, F.lit(r"<loc[^>]*>\s*([^<]*?)\s*</loc>"), F.lit(1)), pstrip)
    return documents.select(
        F.col(url).alias("url"),
        F.when(safe.isNotNull(), loc("sitemap")).otherwise(F.filter(loose, lambda u: F.lower(u).contains("sitemap"))).alias("sitemaps"),
        F.when(safe.isNotNull(), loc("url")).otherwise(F.filter(loose, lambda u: ~F.lower(u).contains("sitemap"))).alias("pages"),
    )


def inner_html(node: Node) -> str:
    import html as h

    def show(x) -> str:
        if isinstance(x, str):
            return h.escape(x, quote=False)
        attrs = "".join(f' {k}="{h.escape(v)}"' for k, v in x.attrs.items())
        body = "".join(map(show, x.children))
        return f"<{x.tag}{attrs}>{body}" + ("" if not x.children and x.tag in ("img", "br", "hr", "source", "input", "meta", "link") else f"</{x.tag}>")

    return show(node)


PARTS = "title string, cover_image string, ingredients_html string, instructions_html string, notes_html string, step_images array<string>, base_url string"


def parts(pages: DataFrame, url: str, html: str, selectors: dict) -> DataFrame:
    """``url`` and the parts of a page for the paragraph cleaner: section fragments, cover, step images."""
    chosen = {k: selectors_of(selectors.get(k)) for k in ("title", "ingredients", "instructions", "notes")}

    def first(root: Node, wanted: list[str]) -> Node | None:
        for s in wanted:
            try:
                if found := select(root, s):
                    return found[0]
            except SelectorError:
                continue
        return None

    def make():
        def row(k, page):
            root = parse(page)
            meta = lambda name: next((n.attrs.get("content", "").strip() for n in select(root, f'meta[property="{name}"]')), "")
            head = first(root, chosen["title"])
            nodes = {f: first(root, chosen[f]) for f in ("ingredients", "instructions", "notes")}
            steps = [n.attrs.get("src", "") for n in select(nodes["instructions"], "img[src]")] if nodes["instructions"] else []
            yield k, text_or_none(head) or meta("og:title"), meta("og:image") or None, *(inner_html(n) if n else None for n in nodes.values()), [u for u in steps if u.startswith(("http://", "https://"))], k

        return row

    return arrow_flat_map(pages.select(F.col(url).alias("url"), html), make, "url string, " + PARTS)


def fragment_text(fragment: Column) -> Column:
    """An HTML fragment as lines: scripts and tables dropped, images as lines of their own. The caller ships the package first."""

    @F.pandas_udf("string")
    def text(values):
        def one(value):
            root = parse(value)

            def lines(node):
                for x in node.children:
                    if isinstance(x, str):
                        if x.strip():
                            yield x.strip()
                    elif x.tag == "img" and "src" in x.attrs:
                        yield f"[Image: {x.attrs['src']}]"
                    elif x.tag not in ("script", "style", "noscript", "iframe", "table"):
                        yield from lines(x)

            return "\n".join(lines(root))

        return values.map(one, na_action="ignore")

    return text(fragment)
