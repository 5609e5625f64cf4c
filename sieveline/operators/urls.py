"""The URL frontier: rules, normal forms, unions, first-seen order, walks."""

from __future__ import annotations

import re
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pstrip
from ..session import checkpoint
from ..sources.arrow import arrow_flat_map


def rule_parts(rules) -> tuple[list[str], list[str]]:
    """``(patterns, substrings)`` of a rule list.

    A rule between slashes is a pattern, case aside; anything else is a
    substring, and so is the body of a pattern that doesn't compile. Blank
    rules, other types, and rules given as a mapping count for nothing.
    """
    patterns, substrings = [], []
    if isinstance(rules, str):
        rules = [rules]
    for rule in rules if isinstance(rules, (list, tuple)) else []:
        rule = rule.strip() if isinstance(rule, str) else ""
        if len(rule) >= 2 and rule[0] == rule[-1] == "/":
            body = rule[1:-1]
            try:
                re.compile(body)
                patterns.append(body)
            except re.error:
                substrings.append(body.lower())
        elif rule:
            substrings.append(rule.lower())
    return patterns, substrings


def url_allowed(url: Column, allow, deny) -> Column:
    """Denied by any deny rule; otherwise allowed by any allow rule, or where there is none. Null urls are not allowed."""
    low = F.lower(url)

    def hit(rules) -> Column:
        patterns, substrings = rule_parts(rules)
        tests = [low.rlike(f"(?iu){p}") for p in patterns] + [low.contains(s) for s in substrings]
        out = F.lit(False)
        for t in tests:
            out = out | t
        return out

    allowed = hit(allow) if any(rule_parts(allow)) else F.lit(True)
    return F.coalesce(~hit(deny) & allowed, F.lit(False))


def parsed_rules(configs: DataFrame, domain: str, allow: str, deny: str) -> DataFrame:
    """Rule lists of many sites as columns: ``domain`` and patterns and substrings of each side."""

    def make():
        def row(site, allowed, denied):
            sides = (dict(zip(("patterns", "substrings"), rule_parts(rules))) for rules in (allowed, denied))
            yield site, *sides

        return row

    side = "struct<patterns:array<string>,substrings:array<string>>"
    return arrow_flat_map(configs.select(domain, allow, deny), make, f"domain string, allow {side}, deny {side}")


def url_allowed_by(url: Column, allow: Column, deny: Column) -> Column:
    """``url_allowed`` with rules from columns, as ``parsed_rules`` gives them; null rules are no rules."""
    low = F.lower(url)

    def hit(rules: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.exists(F.coalesce(rules["patterns"], none), lambda p: F.regexp_like(low, F.concat(F.lit("(?iu)"), p))) | F.exists(F.coalesce(rules["substrings"], none), lambda s: low.contains(s))

    some = F.coalesce((F.size(allow["patterns"]) + F.size(allow["substrings"])) > 0, F.lit(False))
    return F.coalesce(url.isNotNull() & ~hit(deny) & (~some | hit(allow)), F.lit(False))


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def normalize_url(url: Column) -> Column:
    """Trimmed, without fragment and without slashes at the end."""
    return F.regexp_replace(F.regexp_replace(pstrip(url), "(?s)#.*$", ""), "/+$", "")


def prefix_allowed(url: Column, prefixes: list[str], blocked: list[str]) -> Column:
    """Begins with any of ``prefixes`` (where there are some) and holds none of ``blocked``; case counts."""
    begins = F.lit(not prefixes)
    for p in prefixes:
        begins = begins | url.startswith(p)
    for b in blocked:
        begins = begins & ~url.contains(b)
    return begins


def absolute_url(base: Column, href: Column) -> Column:
    """``urljoin``; hrefs with a scheme or from the root are resolved without Python."""

    @F.pandas_udf("string")
    def join(bases, hrefs):
        return bases.combine(hrefs, lambda b, h: urljoin(b, h) if h is not None and b is not None else None)

    ready = href.rlike(r"^https?://[^/?#]+(?:/(?!\.)[^?#./]*)*$")
    return F.when(ready, href).otherwise(join(F.when(~ready, base), F.when(~ready, href)))


def sitemap_root(domain: Column, sitemap_url: Column) -> Column:
    return F.coalesce(F.nullif(sitemap_url, F.lit("")), F.concat(F.lit("https://"), domain, F.lit("/sitemap.xml")))


def frontier(index_urls: DataFrame, sitemap_urls: DataFrame) -> DataFrame:
    return index_urls.select("url").union(sitemap_urls.select("url")).distinct()


def discovered(anchors: DataFrame, prefixes: list[str], blocked: list[str]) -> DataFrame:
    """``url, entry, pos``: allowed addresses of anchors (``entry, base, pos, href``), resolved against their page, in normal form, each where it is seen first."""
    resolved = anchors.select(normalize_url(absolute_url(F.col("base"), F.col("href"))).alias("url"), "entry", "pos")
    return first_seen_links(resolved.where(prefix_allowed(F.col("url"), prefixes, blocked)), "url", ["entry", "pos"])


def first_seen_links(links: DataFrame, url: str, order: list[str]) -> DataFrame:
    """Of each url the row that comes first by ``order``. A url repeated a billion times costs one row a partition: the least is pre-aggregated."""
    rest = [c for c in links.columns if c != url]
    least = links.groupBy(url).agg(F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])).alias("_first"))
    return least.select(url, *[F.col(f"_first.{c}").alias(c) for c in rest])


def follow(start: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """``root, page, step``: pages reached from each root over ``root → next`` edges, up to ``most`` pages in all."""
    front = start.select(F.col("page").alias("root"), "page", F.lit(1).alias("step"))
    out = front
    for step in range(2, most + 1):
        front = front.join(edges, "page").select("root", F.col("next").alias("page"), F.lit(step).alias("step")).distinct()
        out = out.unionByName(front)
    return out


def walk_sitemaps(roots: DataFrame, documents: DataFrame) -> DataFrame:
    """``url``: pages listed by the sitemaps reached from ``roots``, cycles visited once.

    ``documents`` has ``url, sitemaps, pages`` of each fetched sitemap. There
    are as many rounds as the deepest nesting; each checkpoints its frontier.
    """
    front = visited = checkpoint(roots.select("url").distinct())
    found = None
    while not front.isEmpty():
        opened = front.join(documents, "url")
        pages = opened.select(F.explode("pages").alias("url"))
        found = pages if found is None else found.union(pages)
        front = checkpoint(opened.select(F.explode("sitemaps").alias("url")).distinct().join(visited, "url", "left_anti"))
        visited = visited.union(front)
    return found.distinct() if found is not None else visited.limit(0)
