"""Problem 6: text that looks the same in one consistent form.

A vocabulary trie is walked by a weighted edit automaton in which known
look-alikes and ignorable characters cost nothing, a letter of another script
within a Latin word stands for any one letter at cost one, and other edits at
more; a token reached within its budget, by one word alone, takes that word's
spelling. So letters that no table lists are settled by the words they stand
in. Tokens that no vocabulary word matches are folded by the character table.
The vocabulary is a fixed list, the same for every corpus and every size of it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_flat_map, checkpoint

# Look-alike letters, each with the Latin letter it shows.
CYRILLIC = dict(zip("аеорсухіѕјһԁԛԝАВЕКМНОРСТУХІЅЈ", "aeopcyxisjhdqwABEKMHOPCTYXISJ"))
GREEK = dict(zip("οΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oABEZHIKMNOPTYX"))
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
IGNORABLE_RANGES = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF)]
SPACE_RANGES = [(0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
HYPHENS = [0x2010, 0x2011]
LETTERLIKE = (0x2100, 0x2150)
COMPATIBLE_RANGES = [(0xFF61, 0xFF9F), (0xFFE0, 0xFFE6), (0x1D400, 0x1D7FF)]


def _table() -> dict[int, str]:
    fold = {ord(k): v for k, v in (CYRILLIC | GREEK | LIGATURES).items()}
    fold |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    fold |= {c: " " for a, b in SPACE_RANGES for c in range(a, b + 1)}
    fold |= {c: "" for a, b in IGNORABLE_RANGES for c in range(a, b + 1)}
    fold |= {c: "-" for c in HYPHENS}
    fold |= {c: unicodedata.normalize("NFKC", chr(c)) for a, b in COMPATIBLE_RANGES for c in range(a, b + 1)}
    fold |= {c: unicodedata.normalize("NFKC", chr(c)) for c in range(*LETTERLIKE) if unicodedata.decomposition(chr(c)).startswith("<font>")}
    fold[ord("\r")] = ""
    return fold


FOLD = _table()
SUSPECTS = frozenset(map(chr, FOLD)) | frozenset(map(chr, range(0x300, 0x370)))
_IGNORED = "".join(re.escape(chr(c)) for c, v in FOLD.items() if not v)
TOKEN = re.compile(rf"[\w{_IGNORED}\u0300-\u036f]+")


def suspicious(text: str) -> bool:
    """Whether any character of the text is a look-alike, ignorable or combining one."""
    return not (text.isascii() and "\r" not in text) and not SUSPECTS.isdisjoint(text)


#: A letter beyond Latin next to a Latin one: the word may hide a look-alike that no table lists.
MIXED = re.compile(r"[A-Za-z][\u0370-\u1dff\u2c00-\u2dff\ua4d0-\uabff]|[\u0370-\u1dff\u2c00-\u2dff\ua4d0-\uabff][A-Za-z]|[A-Za-z]*[\u0250-\u02af][A-Za-z]*")


def foreign(ch: str) -> bool:
    """Whether a character is a letter of no Latin alphabet that the table doesn't list."""
    return ch >= "\u0250" and ord(ch) not in FOLD and ch.isalpha() and not "\u1e00" <= ch <= "\u1eff" and not "\u2e80" <= ch <= "\ua4cf" and not "\uac00" <= ch <= "\ud7ff"


def fold_table(text: str) -> str:
    """Every look-alike to its plain character, ignorables dropped, accents composed."""
    return unicodedata.normalize("NFC", text.translate(FOLD))


def fold(text: str) -> str:
    """``fold_table`` for texts that need it; others come back as they are."""
    return fold_table(text) if suspicious(text) else text


def aligned(text: str) -> tuple[str, list[int]]:
    """The folded text, and for each of its characters where in the text it begins; one more entry ends the list."""
    out, starts, i = [], [], 0
    while i < len(text):
        end = i + 1
        while end < len(text) and unicodedata.combining(text[end]):
            end += 1
        shown = fold_table(text[i:end])
        out.append(shown)
        starts += [i] * len(shown)
        i = end
    return "".join(out), [*starts, len(text)]


class Trie:
    """Vocabulary words by character; ``end`` marks the words."""

    __slots__ = ("root",)
    END = ""

    def __init__(self, words: Iterable[str] = ()):
        self.root: dict = {}
        for w in words:
            node = self.root
            for ch in w:
                node = node.setdefault(ch, {})
            node[self.END] = w

    def match(self, token: str, budget: int = 0) -> str | None:
        """The cheapest vocabulary spelling of ``token``, ties by spelling; None beyond the budget.

        A state is a trie node with its least cost so far. Reading a character
        keeps the state for ignorables, follows the characters that it shows
        for nothing, and follows, skips or inserts others at cost one each.
        """
        ends = self.reached(token, budget)
        return min(ends)[1] if ends else None

    def settled(self, token: str) -> str | None:
        """The one word that ``token`` shows where each letter of another script may stand for any letter, and nothing else is edited.

        At most a third of its letters may be such; None where no word or more
        than one is reached at the least cost.
        """
        strange = sum(map(foreign, token))
        if not strange or 3 * strange > len(token):
            return None
        ends = sorted(self.reached(token, strange, only_foreign=True))
        return ends[0][1] if ends and (len(ends) == 1 or ends[1][0] > ends[0][0]) else None

    def reached(self, token: str, budget: int, only_foreign: bool = False) -> list[tuple[int, str]]:
        """``(cost, word)`` of the words within the budget; where ``only_foreign``, letters of other scripts alone may be edited, letter for letter."""
        states = {id(self.root): (0, self.root)}
        if not only_foreign:
            states = self._closed(states, budget)
        for ch in unicodedata.normalize("NFC", token):
            shown = FOLD.get(ord(ch), ch)
            after: dict[int, tuple[int, dict]] = {}

            def reach(node: dict, cost: int) -> None:
                if cost <= budget and (id(node) not in after or after[id(node)][0] > cost):
                    after[id(node)] = (cost, node)

            for cost, node in states.values():
                if not shown:
                    reach(node, cost)
                    continue
                for way in {ch, shown}:
                    step: dict | None = node
                    for x in way:
                        step = step.get(x) if step else None
                    if step:
                        reach(step, cost)
                if cost < budget and (not only_foreign or foreign(ch)):
                    if not only_foreign:
                        reach(node, cost + 1)
                    for x, step in node.items():
                        if x and (not only_foreign or x.isupper() == ch.isupper()):
                            reach(step, cost + 1)
            states = after if only_foreign else self._closed(after, budget)
            if not states:
                return []
        return [(cost, node[self.END]) for cost, node in states.values() if self.END in node]

    def _closed(self, states: dict, budget: int) -> dict:
        """Insertions: further nodes at cost one for each character."""
        front = [x for x in states.values() if x[0] < budget]
        while front:
            cost, node = front.pop()
            for x, step in node.items():
                if x and (id(step) not in states or states[id(step)][0] > cost + 1):
                    states[id(step)] = (cost + 1, step)
                    if cost + 1 < budget:
                        front.append((cost + 1, step))
        return states


class Canonicalizer:
    """Text to its canonical form; tokens once looked up are remembered."""

    REMEMBERED = 200_000

    def __init__(self, vocabulary: Iterable[str] = ()):
        self.trie = Trie(fold_table(w) for w in vocabulary)
        self.seen: dict[str, str] = {}

    def token(self, match: re.Match) -> str:
        token = match[0]
        if token.isascii():
            return token
        if (known := self.seen.get(token)) is None:
            if len(self.seen) >= self.REMEMBERED:
                self.seen.clear()
            known = self.seen[token] = self.trie.match(token) or MIXED.search(token) and self.trie.settled(token) or fold_table(token)
        return known

    def __call__(self, text: str) -> str:
        if not (suspicious(text) or not text.isascii() and MIXED.search(text)):
            return text
        return fold_table(TOKEN.sub(self.token, text))


@lru_cache(maxsize=1)
def _canonicalizer(vocabulary: tuple[str, ...]) -> Canonicalizer:
    """One trie for all tasks of a Python worker."""
    return Canonicalizer(vocabulary)


def vocabulary_of(words: Iterable[str], more: Iterable[str] = ()) -> list[str]:
    """Lists of words in lower case and with a capital, for the trie. Lists are fixed: no count over a corpus decides what a text becomes."""
    plain = dict.fromkeys(w.lower() for w in (*words, *more) if len(w) > 3)
    return [w for x in plain for w in (x, x.capitalize())]


def canonical(df: DataFrame, key: str, text: str, vocabulary: list[str] = ()) -> DataFrame:
    """``key, clean, canon, exact``: canonical text, its digest and that of the text as it is.

    Null texts give null in all three; an empty text is a text of its own.
    """
    vocabulary = tuple(vocabulary)

    def make():
        c = _canonicalizer(vocabulary)

        def row(k, t):
            if t is None:
                yield k, None, None, None
            else:
                clean = c(t)
                digest = lambda s: hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                yield k, clean, digest(clean), digest(t)

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(key, text), make, f"`{key}` {kind}, clean string, canon binary, exact binary")


def _hashed(df: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """``key, canon, exact``, written once: texts are read once, and digests several times."""
    return checkpoint(canonical(df.where(F.col(text).isNotNull() & F.col(key).isNotNull()), key, text, vocabulary).select(key, "canon", "exact"))


def _several(hashed: DataFrame) -> DataFrame:
    """Canonical forms with two spellings or more; a group of exact copies is one partial row a partition."""
    return hashed.groupBy("canon").agg(F.min("exact").alias("_a"), F.max("exact").alias("_b")).where("_a <> _b").select("canon")


def lookalike_classes(df: DataFrame, key: str, text: str, vocabulary: list[str] = ()) -> DataFrame:
    """``key, class_id, spelling``: rows whose text looks like another that differs in characters, by class and by spelling within it.

    ``class_id`` is the least key of the class and ``spelling`` the least key
    of the rows of identical text, so the rows of a class are as many as its
    members and no pairs are made. Null texts and null keys are in no class.
    """
    hashed = _hashed(df, key, text, vocabulary)
    members = hashed.join(_several(hashed), "canon", "left_semi")
    spelled = members.groupBy("canon", "exact").agg(F.min(key).alias("spelling"))
    classes = spelled.groupBy("canon").agg(F.min("spelling").alias("class_id"))
    return members.join(spelled, ["canon", "exact"]).join(classes, "canon").select(key, "class_id", "spelling")


def lookalike_pairs(df: DataFrame, key: str, text: str, vocabulary: list[str] = ()) -> DataFrame:
    """``{key}_a, {key}_b`` with a < b: texts that look the same but differ in characters, every pair of rows.

    The result is as large as its definition; ``lookalike_classes`` tells the
    same in one row for each member. Classes of identical texts are joined
    first, one row for each class, and only then expanded to their rows. Null
    texts and null keys are in no pair.
    """
    hashed = _hashed(df, key, text, vocabulary)
    members = hashed.join(_several(hashed), "canon", "left_semi")
    spelled = members.select("canon", "exact").distinct()
    a = spelled.select("canon", F.col("exact").alias("exact_a"))
    b = spelled.select("canon", F.col("exact").alias("exact_b"))
    classes = a.join(b, "canon").where("exact_a < exact_b").drop("canon")
    left = members.select(F.col("exact").alias("exact_a"), F.col(key).alias("ka"))
    right = members.select(F.col("exact").alias("exact_b"), F.col(key).alias("kb"))
    pairs = classes.join(left, "exact_a").join(right, "exact_b")
    return pairs.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"))
