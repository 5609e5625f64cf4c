"""The pipeline cleaner, content assembly and the accept-or-reject gates.

Every step is a Column function; the order of ``clean_text`` is part of its
meaning. Null counts as an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LINE_END, pstrip, replace_each, rx, words_rx

# Fixed values of the cleaner.
FULL_WIDTH = "，。！？【】（）％＃＠＆：；“”‘’《》"
HALF_WIDTH = ",.!?[]()%#@&:;\"\"''<>"
DASHES = "‐‑‒–—―"
MATH_WORDS = [
    ("±", "+/-"), ("×", "x"), ("÷", "/"), ("√", "sqrt"), ("∑", "sum"), ("∏", "prod"), ("≈", "~"),
    ("≤", "<="), ("≥", ">="), ("∞", "inf"), ("∫", "integral"), ("∂", "d"), ("∆", "delta"), ("∇", "nabla"),
]
DECORATION = r"[\x{1F300}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{2600}-\x{27FF}]"
NOISE = (
    r"photo\s*credit|image\s*source|stock\s*image|affiliate|sponsored|buy\s*now|add\s*to\s*cart|comments?|newsletter|subscribe|"
    r"related\s+(?:posts|recipes)|read\s+more|share|pin\s+it|follow\s+me|amazon|world\s+market|copyright|all\s+rights\s+reserved|"
    r"watch\s+the\s+video(?:\s+(?:above|below))?|video\s+tutorial|tiktok|faqs?"
)
NOISE_FIRST = "piabscnrfwvt"
BULLETS = r"[\-–—/*•·▪●◦]"
MIN_CHARS = 220


def narrow_punctuation(col: Column) -> Column:
    """Ideographic and no-break spaces to blanks, full-width punctuation to ASCII."""
    return F.translate(col, "　 " + FULL_WIDTH, "  " + HALF_WIDTH)


def drop_tags_and_entities(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, "<[^>]+>", ""), "&[a-zA-Z0-9#]+;", " ")


def ascii_symbols(col: Column) -> Column:
    """Dashes, ellipsis and mathematical signs to ASCII."""
    single = F.translate(col, DASHES + "−×", "-" * len(DASHES) + "-x")
    return replace_each(single, [("…", "..."), *[p for p in MATH_WORDS if p[0] != "×"]])


def drop_decoration(col: Column) -> Column:
    """Check boxes, emoji and all between them in their ranges, CJK among it."""
    return F.regexp_replace(F.translate(col, "▢☐", ""), DECORATION, "")


def drop_noise(col: Column) -> Column:
    """Noise phrases go, the text around them stays."""
    return F.regexp_replace(col, words_rx(NOISE, NOISE_FIRST), "")


def tidy_lines(col: Column) -> Column:
    """Bullets and leading punctuation off each line, lines of punctuation alone dropped, blank runs collapsed.

    Line ends of all kinds become one kind first; then each rule is one
    multi-line pattern over the whole text, so no text is cut into arrays.
    """
    blank = r"[\s\x{1c}-\x{1f}&&[^\n]]"  # what is left of blanks within a line
    head = "(?dUm)^"
    lines = F.regexp_replace(col, LINE_END, "\n")
    unbulleted = F.regexp_replace(lines, f"{head}{blank}*+{BULLETS}{blank}++", "")
    kept = F.regexp_replace(unbulleted, head + blank + r"*+[,:;.!?)\"'`\-*×]++" + blank + r"*+(?:\n|\z)", "")
    joined = F.regexp_replace(kept, head + r"[,:;.!?)\"'`\-]++" + blank + "*+", "")
    return pstrip(F.regexp_replace(joined, "\n{2,}", "\n"))


def clean_text(col: Column) -> Column:
    """The whole chain, once. Parentheses about FAQs need no step of their own: their word is noise already."""
    marks = ascii_symbols(drop_tags_and_entities(narrow_punctuation(F.coalesce(col, F.lit("")))))
    return tidy_lines(drop_noise(drop_decoration(marks)))


def build_content(image: Column, ingredients: Column, instructions: Column, notes: Column) -> Column:
    """The parts that are there, each under its heading."""

    def part(head: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(head), value))

    shown = F.when(F.coalesce(image, F.lit("")) != "", F.concat(F.lit("[Image: "), image, F.lit("]")))
    return pstrip(F.concat_ws("\n", shown, part("Ingredients:\n", ingredients), part("Instructions:\n", instructions), part("Notes:\n", notes)))


def record_id(url: Column) -> Column:
    return F.sha2(url, 256)


def reject_reason(content: Column, text: Column, error: Column | None = None, min_chars: int = MIN_CHARS) -> Column:
    """``exception:…``, ``image_only`` or ``too_short``, in this order; null where the record is accepted."""
    failed = F.concat(F.lit("exception:"), error) if error is not None else F.lit(None).cast("string")
    alone = F.coalesce(content, F.lit("")).rlike(rx(r"^\s*\[Image:\s*https?://[^\]]+\]\s*\Z", ignore_case=True).replace(r"\Z", r"\z"))
    short = F.length(F.coalesce(text, F.lit(""))) < min_chars
    return F.coalesce(failed, F.when(alone, F.lit("image_only")), F.when(short, F.lit("too_short")))


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def first_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)


def limit_articles(df: DataFrame, url: str, most: int) -> DataFrame:
    """The first ``most`` urls in order; zero is no limit."""
    return df.orderBy(F.col(url).asc_nulls_last()).limit(most) if most else df
