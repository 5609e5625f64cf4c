"""The paragraph cleaner: line normalising, noise blocks, assembly, masking.

It is a cleaner of its own beside ``clean``, with other rules; the tables below
hold its effective values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, pstrip, replace_each, rx, words_rx

# Fixed values of the paragraph cleaner. The punctuation pairs are the effective ones.
PUNCTUATION_FROM = "，。！？【】（）％＃＠＆：；、“”‘’—…《》·"
PUNCTUATION_TO = ",.!?[]()%#@&:;,\"\"''--..<"
MATH_WORDS = [
    ("±", "plus/minus"), ("×", "x"), ("÷", "divided by"), ("√", "square root"), ("∞", "infinity"), ("≈", "approx"),
    ("≠", "not equal"), ("≤", "<="), ("≥", ">="), ("°", " degrees "),
]
MATH_DROPPED = "∑∫∏∆∇∂"
NOISE = r"share|pinterest|facebook|instagram|advertisement|sponsored|copyright|all rights reserved|privacy policy|terms of use"
TEMPLATE_HEADS = r"table of contents|jump to recipe|nutrition facts|related posts|you may also like|faq|newsletter"
EMOJI = r"[\x{2600}-\x{27FF}\x{1F300}-\x{1FAFF}]"
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
CARD = r"\b(?:\d[ -]*?){13,19}\b"
PHONE = r"\b(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{2,4}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}\b"
MASK = "xxx"


def is_markdown(line: Column) -> Column:
    """An image anywhere in the line, or a table row."""
    return line.rlike(r"!\[[^\]]*\]\([^)]+\)") | line.rlike(rx(r"^\s*\|.+\|\s*$"))


def math_guard(line: Column) -> Column:
    return F.translate(replace_each(line, MATH_WORDS), MATH_DROPPED, "")


def norm_line(line: Column, lang: Column | str = "en") -> Column:
    """One line in normal form; empty where it is Markdown. Null lines stay null."""
    lang = F.lit(lang) if isinstance(lang, str) else lang
    bare = F.regexp_replace(line, EMOJI, "")
    bare = F.when(lang == "en", F.translate(bare, PUNCTUATION_FROM, PUNCTUATION_TO)).otherwise(bare)
    bare = F.regexp_replace(bare, rx(r"^\s*(?:[•·\-*]|▢)\s*"), "")
    bare = F.regexp_replace(bare, rx(r"^\s*#\s*"), "")
    bare = pstrip(F.regexp_replace(bare, rx(r"\s+"), " "))
    return F.when(is_markdown(line), F.lit("")).otherwise(math_guard(bare))


def collapse_blanks(lines: Column) -> Column:
    """Runs of empty lines to one."""
    return let(lines, lambda all_: F.filter(all_, lambda x, i: (x != "") | (i == 0) | (F.get(all_, i - 1) != "")))


def drop_noise_blocks(lines: Column) -> Column:
    """Lines with noise words go; template heads go among the first three and the last two, blank lines counted."""

    def keep(n: Column):
        def test(x: Column, i: Column) -> Column:
            edge = (i < 3) | (i >= n - 2)
            return ~x.rlike(words_rx(NOISE)) & ~(edge & x.rlike(words_rx(TEMPLATE_HEADS)))

        return test

    return let(lines, lambda all_: F.filter(F.transform(all_, pstrip), keep(F.size(all_))))


def assemble(cover: Column, ingredients: Column, instructions: Column, notes: Column, step_images: Column, lang: Column | str = "en") -> Column:
    """``struct<content, missing_notes, images_count>`` from section texts and step images."""
    none = F.array().cast("array<string>")

    def section(head: str, text: Column, gap: bool) -> Column:
        lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: norm_line(x, lang)), lambda x: x != "")
        heads = F.array(*([F.lit("")] if gap else []), F.lit(head))
        return F.when(F.coalesce(text, F.lit("")) != "", F.concat(heads, lines)).otherwise(none)

    images = F.filter(F.coalesce(step_images, none), lambda u: u.startswith("http://") | u.startswith("https://"))
    blocks = F.concat(
        F.when(F.coalesce(cover, F.lit("")) != "", F.array(F.concat(F.lit("[Image: "), cover, F.lit("]")))).otherwise(none),
        section("Ingredients", ingredients, False), section("Instructions", instructions, True), section("Notes", notes, True),
        F.transform(images, lambda u: F.concat(F.lit("[Image: "), u, F.lit("]"))),
    )
    content = pstrip(F.array_join(collapse_blanks(drop_noise_blocks(collapse_blanks(F.transform(blocks, pstrip)))), "\n"))
    return F.struct(content.alias("content"), (pstrip(F.coalesce(notes, F.lit(""))) == "").alias("missing_notes"), F.size(images).alias("images_count"))


def mask_pii(text: Column) -> Column:
    """Addresses of mail, card numbers, then phone numbers."""
    masked = F.regexp_replace(text, EMAIL, MASK)
    masked = F.regexp_replace(masked, rx(CARD), MASK)
    return F.regexp_replace(masked, rx(PHONE), MASK)
