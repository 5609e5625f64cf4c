"""Column helpers that give Python's text semantics on the JVM.

Java's ``\\s``, ``\\b`` and ``$`` differ from Python's; ``rx`` rewrites a pattern
so that both match the same strings, and ``pstrip`` and ``plines`` are
``str.strip`` and ``str.splitlines``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
_SPACE = r"\s\x{1c}-\x{1f}"
BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
LINE_END = r"\r\n|[\n\x{0b}\x{0c}\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def rx(pattern: str, ignore_case: bool = False, multiline: bool = False) -> str:
    """A Python pattern as a Java pattern with the same matches on text."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            after = pattern[i + 1]
            i += 2
            if after == "s":
                out.append(_SPACE if inside else f"[{_SPACE}]")
            elif after == "S" and not inside:
                out.append(f"[^{_SPACE}]")
            elif after == "b" and not inside:
                out.append(BOUNDARY)
            elif after == "w":
                out.append(WORD[1:-1] if inside else WORD)
            elif after == "d":
                out.append(r"\p{Nd}")
            else:
                out.append("\\" + after)
            continue
        if ch == "[" and not inside:
            inside = True
        elif ch == "[" and inside:
            ch = "\\["  # Java would open a nested class
        elif ch == "]" and inside and out and out[-1] not in ("[", "[^"):
            inside = False
        elif ch == "&" and inside:
            ch = "\\&"
        out.append(ch)
        i += 1
    flags = "dU" + "i" * ignore_case + "u" * ignore_case + "m" * multiline
    return f"(?{flags})" + "".join(out)


def words_rx(alternatives: str, first: str = "") -> str:
    """Whole words of an alternation, case aside; each must begin and end with a word character.

    ``first``: the letters that they begin with; a look at the first letter
    spares the test for a word's edge nearly everywhere.
    """
    body = rx(alternatives)[len("(?dU)") :]
    look = f"(?=[{first}])" if first else ""
    return f"(?dUiu){look}(?<!{WORD})(?:{body})(?!{WORD})"


#: What ``str.strip`` takes off.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def pstrip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def plines(col: Column) -> Column:
    """``str.splitlines``: no entry for an empty text, none after a last line end."""
    parts = F.split(col, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def replace_each(col: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_contained(haystack: Column, needles: list[str]) -> Column:
    """The first of ``needles``, in their order, that the text contains; null if none."""
    words = F.array(*map(F.lit, needles))
    return let(haystack, lambda h: F.get(F.filter(words, lambda n: h.contains(n)), F.lit(0)))


def escape_html(col: Column) -> Column:
    return replace_each(col, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])
