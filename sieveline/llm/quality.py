"""Problem 5: statistics of a text, and from them which texts are not natural prose.

Beside counts of words, symbols and line ends there are repetition statistics
(shares of duplicate lines and paragraphs, characters covered by the dominant
n-grams). Furniture is set aside before anything is counted.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boilerplate, residue
from .common import arrow_flat_map
from .visual import fold

WORDS = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
CJK = re.compile(r"[㐀-鿿]")
CELL = re.compile(r"^[~<>≤≥]?[-+]?\d[\d.,/]*\s?(?:%|[a-zA-Zµ]{1,4})?$|^[-–—]$|^n/?a$", re.I)
CELLS = re.compile(r"\t+| {2,}|\s*\.{3,}\s*|\s*[;|]\s*|,\s+")
ENTRY_MARK = re.compile(r"^\s*(?:[-*+•·▢☐◦‣–]|\d{1,3}[.)])\s+|\s*<[^<>]*>\s*")
END = re.compile(r"[.!?…。！？:：][\"'”’)\]]*$")
VOWEL = re.compile(r"[aeiouyàáâäæèéêëìíîïòóôöœùúûüAEIOUY]")
CLUSTER = re.compile(r"[^aeiouy\W\d_]{5}|(.)\1\1")
KEYBOARD = re.compile(r"[asdfghjkl;qwe\s]")
MOJIBAKE = re.compile(r"[\x80-\xbfÃÂâ€™œžŸ]")
ODD = re.compile(r"[^\w\s.,;:!?'\"’()/%°&\[\]#*-]")
SYMBOL = re.compile(r"[^\w\s]")

STATS = (
    "words int, mean_word_length double, symbol_ratio double, digit_ratio double, end_share double, common_share double, mean_line_words double, "
    "duplicate_line_share double, duplicate_paragraph_share double, top_2gram_share double, top_3gram_share double, top_4gram_share double, distinct_word_share double, "
    "sentence_share double, entry_share double, value_share double, noise_share double"
)


def _common_words() -> frozenset[str]:
    return residue.EVERYDAY


@lru_cache(maxsize=8)
def _wide(common: frozenset[str]) -> frozenset[str]:
    """The common words that are written without blanks."""
    return frozenset(w for w in common if CJK.match(w)) or frozenset("的了在是不也和就")


def line_kind(line: str, common: frozenset[str], words: list[str] | None = None) -> str:
    """``sentence``, ``entry``, ``value``, ``noise`` or empty (too little to tell). ``words``: those of the line in lower case, where they are at hand."""
    text = line.strip()
    words = WORDS.findall(text.lower()) if words is None else words
    hits = len(common.intersection(words))
    # most lines of prose end here
    if len(words) >= 8 and hits >= 2 and 6 * hits >= len(words) and ";" not in text and len(set(words)) > 1 + len(words) // 8:
        return "sentence"
    bare = ENTRY_MARK.sub("", text).strip()
    if not bare:
        return ""
    if bare != text:
        text = bare
        words = WORDS.findall(text.lower())
    if not text.isascii():
        zh = len(CJK.findall(text))
        if zh >= 4 and zh * 3 >= len(text):
            # without a common word or an end, a short line of characters is an entry
            return "sentence" if zh > 12 or END.search(text) or any(w in text for w in _wide(common)) else "entry"
        if 5 * len(MOJIBAKE.findall(text)) >= max(20, len(text)):
            return "noise"
    hits = len([w for w in words if w in common])
    if not words:
        return "noise" if len(text) >= 5 else ""
    cells = [c for c in CELLS.split(text) if c]
    values = sum(1 for c in cells if CELL.match(c))
    if len(cells) >= 2 and 2 * values >= len(cells) and not CELL.match(cells[0]):
        return "value"
    if len(words) >= 4 and all(w[0].isdigit() for w in words):
        return "noise"
    if len(words) >= 6 and len(set(words)) <= 1 + len(words) // 8:
        return "noise"
    if len(words) <= 3 and max(map(len, words)) > 32:
        return "noise"
    letters = sum(map(str.isalpha, text))
    if letters * 2 < len(text) and 4 * len(ODD.findall(text)) >= len(text):
        return "noise"
    if len(words) >= 3 and 3 * hits <= len(words):
        strange = sum(1 for w in words if len(w) >= 3 and (not VOWEL.search(w) or CLUSTER.search(w)))
        if strange * 3 >= len(words):
            return "noise"
        if strange and len(text) > 12 and ";" in text and len(KEYBOARD.findall(text)) >= 0.97 * len(text):
            return "noise"
    if len(words) >= 6 and hits * 8 >= len(words) or len(words) >= 4 and hits and END.search(text):
        return "sentence"
    commas = text.count(",") + text.count("，")
    if len(words) <= 7 or commas >= 2 and len(words) <= 6 * (commas + 1):
        return "entry"
    return "sentence" if hits else "noise" if not END.search(text) else ""


def top_ngram_shares(words: list[str]) -> tuple[float, float, float]:
    """For two, three and four words: characters of the most frequent n-gram, all its occurrences, over all characters of words; zero where none comes twice.

    Only where a shorter n-gram and the one after it come again can a longer one.
    """
    total, out = sum(map(len, words)), [0.0, 0.0, 0.0]
    places = range(len(words) - 1)
    for n in (2, 3, 4):
        grams = list(zip(words, words[1:])) if n == 2 else [tuple(words[i : i + n]) for i in places]
        counts = Counter(grams)
        gram = max(counts, key=counts.get, default=())
        if not gram or counts[gram] < 2:
            break
        out[n - 2] = min(1.0, counts[gram] * sum(map(len, gram)) / total)
        again = {i for i, g in zip(places, grams) if counts[g] > 1}
        places = [i for i in sorted(again) if i + 1 in again]
    return tuple(out)


def lines_of_body(text: str, url: str | None, blank: bool = False) -> list[str]:
    """Lines without furniture and images; blank ones only where wanted."""
    folded = fold(text)
    drop = set(boilerplate.furniture(folded, url))
    return [line for i, line in enumerate(folded.split("\n"), 1) if i not in drop and (blank or line.strip()) and not line.lstrip().startswith("[Image")]


def statistics(text: str, url: str | None = None, common: frozenset[str] | None = None) -> dict[str, float]:
    """The numbers of ``STATS`` for one text; all zero for a text without a body."""
    common = common or _common_words()
    spaced = lines_of_body(text, url, blank=True)
    lines = [line for line in spaced if line.strip()]
    whole = "\n".join(lines)
    each = [WORDS.findall(line.lower()) for line in lines]
    words = [w for ws in each for w in ws]
    chars = sum(map(len, lines)) or 1
    counts = Counter(words)
    kinds = Counter()
    for line, ws in zip(lines, each):
        if not boilerplate.HEADING.match(boilerplate.plain(line)):
            kinds[line_kind(line, common, ws)] += len(line)
    weight = sum(kinds.values()) or 1
    top2, top3, top4 = top_ngram_shares(words)
    paragraphs = [p for p in re.split(r"\n\s*\n", "\n".join(spaced)) if p.strip()]

    def duplicates(parts: list[str]) -> float:
        return (len(parts) - len({p.strip().lower() for p in parts})) / len(parts) if parts else 0.0

    return {
        "words": len(words),
        "mean_word_length": sum(map(len, words)) / len(words) if words else 0.0,
        "symbol_ratio": len(SYMBOL.findall(whole)) / chars,
        "digit_ratio": sum(map(whole.count, "0123456789")) / chars,
        "end_share": sum(1 for line in lines if END.search(line.rstrip())) / len(lines) if lines else 0.0,
        "common_share": sum(n for w, n in counts.items() if w in common) / len(words) if words else 0.0,
        "mean_line_words": len(words) / len(lines) if lines else 0.0,
        "duplicate_line_share": duplicates(lines),
        "duplicate_paragraph_share": duplicates(paragraphs),
        "top_2gram_share": top2,
        "top_3gram_share": top3,
        "top_4gram_share": top4,
        "distinct_word_share": len(counts) / len(words) if words else 0.0,
        "sentence_share": kinds["sentence"] / weight,
        "entry_share": kinds["entry"] / weight,
        "value_share": kinds["value"] / weight,
        "noise_share": kinds["noise"] / weight,
    }


#: From so many words on, a text can be judged by its repetitions.
LEAST_WORDS = 30


def repetition(stats: dict[str, float]) -> float:
    """How much of a text says again what it said: the largest of the shares of duplicate lines and paragraphs and of what the dominant n-grams cover."""
    return max(stats["duplicate_line_share"], stats["duplicate_paragraph_share"], stats["top_2gram_share"], stats["top_3gram_share"], stats["top_4gram_share"])


def shape(stats: dict[str, float]) -> str:
    """``prose``, ``list``, ``table`` or ``junk`` by combined rules; a text without words or marks is prose.

    A text of some length that hardly does anything but repeat itself is junk,
    whatever its lines look like: by its lines and paragraphs, or by one n-gram
    over few distinct words. Otherwise the kinds of its lines decide, junk the
    more so the more it repeats.
    """
    few = stats["distinct_word_share"] < 0.1
    if stats["words"] >= LEAST_WORDS and (stats["duplicate_line_share"] >= 0.7 or stats["duplicate_paragraph_share"] >= 0.7 or few and max(stats["top_3gram_share"], stats["top_4gram_share"]) >= 0.5):
        return "junk"
    if stats["sentence_share"] >= 0.35:
        return "prose"
    shares = {"junk": stats["noise_share"] + (0.5 if few and repetition(stats) > 0.5 else 0.0), "table": stats["value_share"], "list": stats["entry_share"]}
    best = max(shares, key=lambda k: (shares[k], k))
    return best if shares[best] > 0.3 else "prose"


def text_statistics(df: DataFrame, key: str, text: str, url: str, common: frozenset[str] | None = None) -> DataFrame:
    """``key``, the columns of ``STATS`` and ``shape``: one row for each row.

    Null texts give null statistics and shape; empty ones give zeros and
    ``prose``. A text that is template residue or an error page has the shape
    ``residue``. No shuffle.
    """
    names = [x.split()[0] for x in STATS.split(", ")]
    common = frozenset(common or _common_words())

    def make():
        def row(k, t, u):
            if t is None:
                yield (k, *[None] * len(names), None)
            else:
                s = statistics(t, u, common)
                what = shape(s)
                if what != "prose" and residue.examine(t, u)[0]:
                    what = "residue"
                yield (k, *(s[n] for n in names), what)

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(F.col(key), F.col(text), F.col(url)), make, f"`{key}` {kind}, {STATS}, shape string")


def not_prose(df: DataFrame, key: str, text: str, url: str, common: frozenset[str] | None = None) -> DataFrame:
    """``key, kind`` of the rows that are a bare list, a table or junk."""
    return text_statistics(df, key, text, url, common).where(F.col("shape").isin("list", "table", "junk")).select(key, F.col("shape").alias("kind"))
