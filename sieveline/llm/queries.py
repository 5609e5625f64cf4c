"""The registered queries of the ten problems, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boilerplate, leakage, level, markup, packing, pii, quality, repeated, residue, visual
from .common import checkpoint, records, table

#: common_words is a fixed list; more rows than this are no list of common words.
MAX_COMMON_WORDS = 5000


def common_words(spark: SparkSession, sf_dir: str) -> frozenset[str]:
    rows = table(spark, sf_dir, "common_words").select("word").dropna().limit(MAX_COMMON_WORDS + 1).collect()
    if len(rows) > MAX_COMMON_WORDS:
        raise ValueError("common_words is larger than a list of common words")
    return frozenset(r.word.lower() for r in rows)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup(records(spark, sf_dir), "rec_no", "content").select("rec_no", F.explode("kinds").alias("kind"))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup(records(spark, sf_dir), "rec_no", "content").select("rec_no", "clean")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(records(spark, sf_dir), "rec_no", "content", url="url")


def p2_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.masked(records(spark, sf_dir), "rec_no", "content", url="url")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.furniture_lines(records(spark, sf_dir), "rec_no", "content", "url")


def p3_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_content(records(spark, sf_dir), "rec_no", "content", "url")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated.excess_occurrences(records(spark, sf_dir), "rec_no", "content", "url")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated.remove_excess(records(spark, sf_dir), "rec_no", "content", "url")


def p4_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    excess = repeated.excess_lines(records(spark, sf_dir), "content", "url")
    return excess.select("site", F.lower(F.hex("form_id")).alias("form_id"), "urls", "site_urls", F.round("llr", 6).alias("llr"), "significant")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(records(spark, sf_dir), "rec_no", "content", "url", common_words(spark, sf_dir))


def p5_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_statistics(records(spark, sf_dir), "rec_no", "content", "url", common_words(spark, sf_dir))


def p5_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "example_clean").select("rec_no", "text", F.col("meta.data_info.url").alias("url"))
    return quality.text_statistics(rows, "rec_no", "text", "url", common_words(spark, sf_dir))


@lru_cache(maxsize=1)
def _vocabulary() -> tuple[str, ...]:
    return tuple(visual.vocabulary_of(sorted(pii.lexicon_of()[0])))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.lookalike_pairs(records(spark, sf_dir), "rec_no", "content", _vocabulary())


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.lookalike_classes(records(spark, sf_dir), "rec_no", "content", _vocabulary())


def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.canonical(records(spark, sf_dir), "rec_no", "content", _vocabulary()).select("rec_no", "clean")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(records(spark, sf_dir), "rec_no", "content", "url")


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.without_residue(records(spark, sf_dir), "rec_no", "content", "url").select("rec_no", "url")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = packing.token_sizes(table(spark, sf_dir, "documents"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n_tokens", table(spark, sf_dir, "capacities"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_pack(spark, sf_dir), table(spark, sf_dir, "capacities"))


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of every packing, here of groups small enough for the tree: pieces once each and in full, no container over its capacity, hardly any space unused."""
    sizes = checkpoint(packing.token_sizes(table(spark, sf_dir, "documents"), "doc_id", "text"))
    capacities = table(spark, sf_dir, "capacities")
    packed = checkpoint(packing.pack(sizes, "doc_id", "n_tokens", capacities, items_per_group=150, fan_in=4))
    bins = packed.groupBy("capacity_id", "container").agg(F.sum("piece_tokens").alias("fill"))
    per_bin = bins.join(capacities, "capacity_id").groupBy("capacity_id").agg(F.sum((F.col("fill") > F.col("max_tokens")).cast("bigint")).alias("over"), F.count(F.lit(1)).alias("n"), F.sum("fill").alias("tokens"), F.max("max_tokens").alias("room"))
    per_doc = packed.groupBy("capacity_id", "doc_id").agg(F.sum("piece_tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.max("piece").alias("last"))
    wrong = (F.col("t") != F.col("n_tokens")) | (F.col("n") != F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.col("max_tokens")))) | (F.col("last") != F.col("n") - 1)
    docs = per_doc.join(sizes, "doc_id").join(capacities, "capacity_id").groupBy("capacity_id").agg(F.count(F.lit(1)).alias("documents"), F.sum(wrong.cast("bigint")).alias("wrong_documents"))
    tight = F.col("n") <= F.ceil(F.col("tokens") / F.col("room") / 0.98) + 1
    return docs.join(per_bin, "capacity_id").select("capacity_id", "documents", "wrong_documents", F.col("over").alias("over_full"), tight.alias("tight"))


#: Words of a passage that may be inserted, dropped or changed, one for each so many words of it.
NEAR, WORDS_PER_ERROR = 2, 5


def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    return leakage.leaks(docs, "doc_id", "text", items, "item_id", "text", errors=NEAR, words_per_error=WORDS_PER_ERROR)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages within the error budget, of which the definition takes those without an error."""
    return p9_near(spark, sf_dir).where("distance = 0").select("doc_id", "item_id")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = level.train(docs, "doc_id", "text", "source", table(spark, sf_dir, "level_labels"), "level")
    return level.levels(docs, "doc_id", "text", model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).where("level = 3").select("doc_id")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir)


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_source = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    rated = _levels(spark, sf_dir).join(by_source, "doc_id")
    return rated.groupBy("source", "level").agg(F.count(F.lit(1)).alias("documents"), F.avg("score").alias("mean_score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        p1_found, p1_clean, p2_found, p2_masked, p3_found, p3_body, p4_found, p4_clean, p4_excess, p5_found, p5_stats, p5_text_stats,
        p6_found, p6_classes, p6_canonical, p7_found, p7_kept, p8_pack, p8_fill, p8_invariants, p9_found, p9_near, p10_found, p10_levels, p10_profile,
    ]
    return {f.__name__: f for f in own}


_LINES = r"""
WITH r AS (
  SELECT rec_no, meta.data_info.url AS url, string_split(meta.data_info.content, chr(10)) AS parts,
         nullif(regexp_replace(lower(regexp_extract(coalesce(meta.data_info.url, ''), '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#\s]+)', 1)), '^www\.', ''), '') AS site
  FROM example_clean),
l AS (
  SELECT rec_no, url, site, i AS line_no, parts[i] AS line,
         regexp_replace(lower(trim(regexp_replace(parts[i], '[ \t]+', ' ', 'g'), ' ')), '[0-9]+', '0', 'g') AS form
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM r WHERE parts IS NOT NULL)),
n AS (SELECT site, count(DISTINCT url) AS site_urls FROM r WHERE site IS NOT NULL GROUP BY site),
x AS (
  SELECT l.site, form, count(DISTINCT url) AS urls, any_value(site_urls) AS site_urls
  FROM l JOIN n ON l.site = n.site WHERE length(form) >= 25 GROUP BY l.site, form
  HAVING count(DISTINCT url) >= 5 AND count(DISTINCT url) >= 0.1 * any_value(site_urls))
"""


# Excess over other sites: log-likelihood ratio, upper tail of chi-square, Benjamini-Hochberg over twentieths of its decimal logarithm.
_ERFC = "(-1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (-0.18628806 + t * (0.27886807 + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 + t * 0.17087277)))))))))"
_SIGNIFICANT = f"""
, w AS (SELECT l.site, form, count(DISTINCT url) AS urls FROM l WHERE l.site IS NOT NULL AND length(form) >= 25 GROUP BY l.site, form),
o AS (SELECT form, sum(urls) AS all_urls FROM w GROUP BY form),
c AS (SELECT x.site, x.form, x.urls, x.site_urls, CAST(x.urls AS DOUBLE) AS k, CAST(x.site_urls AS DOUBLE) AS n, CAST(all_urls - x.urls AS DOUBLE) AS k2, CAST((SELECT sum(site_urls) FROM n) - x.site_urls AS DOUBLE) AS n2 FROM x JOIN o ON x.form = o.form),
q AS (SELECT *, (k + k2) / (n + n2) AS e FROM c),
g AS (SELECT *, 2 * ((CASE WHEN k > 0 THEN k * ln(k / (n * e)) ELSE 0 END) + (CASE WHEN n > k THEN (n - k) * ln((n - k) / (n * (1 - e))) ELSE 0 END) + (CASE WHEN k2 > 0 THEN k2 * ln(k2 / (n2 * e)) ELSE 0 END) + (CASE WHEN n2 > k2 THEN (n2 - k2) * ln((n2 - k2) / (n2 * (1 - e))) ELSE 0 END)) AS g FROM q),
h AS (SELECT *, sqrt(greatest(g, 0) / 2) AS z, 1 / (1 + sqrt(greatest(g, 0) / 2) / 2) AS t FROM g),
b AS (SELECT *, least(floor(-(ln(t) - z * z + {_ERFC}) / ln(10) * 20), 6000) AS bin FROM h),
m AS (SELECT bin, sum(count(*)) OVER (ORDER BY bin DESC) AS rank, sum(count(*)) OVER () AS total FROM b GROUP BY bin),
cut AS (SELECT coalesce(min(bin), 1000000000) AS least FROM m WHERE bin / 20 >= -log10(0.01 * rank / total)),
s AS (SELECT *, k / n > k2 / greatest(n2, 1) AND bin >= (SELECT least FROM cut) AS significant FROM b)
"""


# Letters of two scripts, each above the Latin letter that looks like it.
_LOOK_ALIKES = {"cyrillic": ("аАВсСԁеЕһНіІјЈКМоОрРԛѕЅТуУхХԝ", "aABcCdeEhHiIjJKMoOpPqsSTyYxXw"), "greek": ("ΑΒΕΖΗΙΚΜΝοΟΡΤΥΧ", "ABEZHIKMNoOPTYX")}


def _unicode_table() -> dict[str, str]:
    """What the Unicode database says of characters: blanks, signs without width, wide, narrow and styled forms, ligatures. Made without the operator's table."""
    shown = dict(zip(*("".join(x) for x in zip(*_LOOK_ALIKES.values()))))
    for n in range(0xA0, 0x20000):
        c, how = chr(n), unicodedata.decomposition(chr(n)).split(" ")[0]
        kind = unicodedata.category(c)
        if kind == "Zs":
            shown[c] = " "
        elif kind == "Cf" and n < 0x13430 and not 0x600 <= n <= 0x6FF and n not in (0x70F, 0x890, 0x891, 0x8E2) or 0xFE00 <= n <= 0xFE0F or n in (0x34F, 0x180B, 0x180C, 0x180D):
            shown[c] = ""
        elif how in ("<wide>", "<narrow>", "<font>") and (n < 0x2150 or 0xFF00 < n < 0xFFF0 or 0x1D400 <= n < 0x1D800) or how == "<compat>" and 0xFB00 <= n <= 0xFB06:
            shown[c] = unicodedata.normalize("NFKC", c)
        elif unicodedata.name(c, "") in ("HYPHEN", "NON-BREAKING HYPHEN"):
            shown[c] = "-"
    return shown | {"\r": ""}


def _folded(text: str) -> str:
    """The characters as SQL: one ``translate``, ligatures by ``replace``, composed accents."""
    table_ = _unicode_table()
    single = {c: v for c, v in table_.items() if len(v) == 1}
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"translate({text}, {quoted(''.join(single) + ''.join(c for c, v in table_.items() if not v))}, {quoted(''.join(single.values()))})"
    for c, v in table_.items():
        if len(v) > 1:
            out = f"replace({out}, {quoted(c)}, {quoted(v)})"
    return f"nfc_normalize({out})"


def oracle_sql() -> dict[str, str]:
    canonical = f"SELECT rec_no, meta.data_info.content AS content, {_folded('meta.data_info.content')} AS clean FROM example_clean"
    return {
        "p6_canonical": f"SELECT rec_no, clean FROM ({canonical})",
        "p6_classes": f"WITH c AS ({canonical}), k AS (SELECT clean, min(rec_no) AS class_id FROM c WHERE content IS NOT NULL GROUP BY clean HAVING count(DISTINCT content) > 1), e AS (SELECT clean, content, min(rec_no) AS spelling FROM c GROUP BY clean, content) SELECT c.rec_no, k.class_id, e.spelling FROM c JOIN k ON c.clean = k.clean JOIN e ON c.clean = e.clean AND c.content = e.content",
        "p6_found": f"WITH c AS ({canonical}) SELECT a.rec_no AS rec_no_a, b.rec_no AS rec_no_b FROM c a JOIN c b ON a.clean = b.clean AND a.rec_no < b.rec_no AND a.content <> b.content",
        "p4_found": _LINES + "SELECT l.rec_no, CAST(l.line_no AS INTEGER) AS line_no FROM l JOIN x ON l.site = x.site AND l.form = x.form",
        "p4_excess": _LINES + _SIGNIFICANT + "SELECT site, md5(form) AS form_id, urls, site_urls, round(g, 6) AS llr, significant FROM s",
        "p4_clean": _LINES
        + _SIGNIFICANT.rstrip()
        + """, k AS (SELECT l.rec_no, string_agg(line, chr(10) ORDER BY line_no) AS clean FROM l LEFT JOIN (SELECT * FROM s WHERE significant) x ON l.site = x.site AND l.form = x.form WHERE x.form IS NULL GROUP BY l.rec_no)
SELECT r.rec_no, CASE WHEN r.parts IS NOT NULL THEN coalesce(k.clean, '') END AS clean FROM r LEFT JOIN k ON r.rec_no = k.rec_no""",
        "p8_invariants": "SELECT capacity_id, (SELECT count(*) FROM documents) AS documents, 0 AS wrong_documents, 0 AS over_full, true AS tight FROM capacities",
        "p9_found": r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
s AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS piece FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM s)),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
z AS (SELECT DISTINCT n FROM p),
g AS (SELECT DISTINCT doc_id, n, array_to_string(w[k : k + n - 1], ' ') AS piece FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, z WHERE len(w) >= n))
SELECT DISTINCT doc_id, item_id FROM g JOIN p ON g.n = p.n AND g.piece = p.piece""",
    }
