"""Problem 9: evaluation texts inside training text.

Pigeonhole matching: each window of a test item is split into one piece more
than the error budget allows, so that any passage within the budget holds one
piece unchanged. Exact piece hits in a document are verified by Myers'
bit-parallel distance over words.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_flat_map

WINDOW = 13
HEAD = 4
WORD = re.compile(r"[^\W_]+")
#: So many characters of items are sent to the tasks at once; more items go in parts, each with a scan of its own.
MAX_ITEM_CHARS = 16_000_000
#: Where many parts still hold too much, items share their keys and go together.
MAX_PARTS = 4096


def words_of(text: str) -> list[str]:
    """Runs of letters or digits in lower case."""
    return WORD.findall(text.lower())


def myers(pattern: list[str], text: list[str], budget: int) -> int:
    """Least edits that turn ``pattern`` into some stretch of ``text``; ``budget + 1`` where more are needed.

    One bit for each word of the pattern, one step for each word of the text.
    """
    m = len(pattern)
    at: dict[str, int] = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance, best = full, 0, m, m
    for w in text:
        same = at.get(w, 0)
        d0 = (((same & up) + up) ^ up) | same | down
        hp = down | ~(d0 | up) & full
        hn = d0 & up
        distance += bool(hp & top) - bool(hn & top)
        best = min(best, distance)
        hp <<= 1  # a match may begin anywhere in the text
        hn <<= 1
        up = (hn | ~(d0 | hp)) & full
        down = hp & d0 & full
    return min(best, budget + 1)


class Pieces:
    """The pieces of all windows of all items, by their first words."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, errors: int = 0, words_per_error: int = 1):
        # by the number of words looked up, at most HEAD, then by those words
        self.by_head: dict[int, dict[tuple[str, ...], list[tuple[tuple[str, ...], int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.windows: list[tuple[int, list[str], int, frozenset[str]]] = []
        seen = set()
        for item, text in items:
            words = words_of(text or "")
            if not words:
                continue
            size = min(window, len(words))
            budget = min(errors, size - 1, size // words_per_error)
            parts = budget + 1
            cuts = [size * i // parts for i in range(parts + 1)]
            for at in range(len(words) - size + 1):
                self.windows.append((item, words[at : at + size], budget, frozenset(words[at : at + size])))
                for a, b in zip(cuts, cuts[1:]):
                    piece = tuple(words[at + a : at + b])
                    if (key := (piece, item, at, a)) not in seen:
                        seen.add(key)
                        self.by_head[min(HEAD, len(piece))][piece[:HEAD]].append((piece, len(self.windows) - 1, a))

    def matches(self, text: str) -> dict[int, int]:
        """Items that the text contains, each with its least distance."""
        words = words_of(text)
        found: dict[int, int] = {}
        for size, heads in self.by_head.items():
            for i, head in enumerate(zip(*(words[j:] for j in range(size)))):
                if head not in heads:
                    continue
                for piece, w, offset in heads[head]:
                    item, window, budget, distinct = self.windows[w]
                    if found.get(item) == 0 or tuple(words[i : i + len(piece)]) != piece:
                        continue
                    begin = max(0, i - offset - budget)
                    stretch = words[begin : i - offset + len(window) + budget]
                    # an error takes at most one word away, so more missing ones are out of reach
                    if len(stretch) + budget < len(window) or len(distinct.difference(stretch)) > budget:
                        continue
                    distance = myers(window, stretch, budget)
                    if distance <= budget and distance < found.get(item, distance + 1):
                        found[item] = distance
        return found


#: The last index that this Python worker built; tasks of one scan share it.
_BUILT: dict[tuple, Pieces] = {}


def _pieces(number: str, rows: list[tuple[int, str]], *how: int) -> Pieces:
    key = (number, *how)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Pieces(rows, *how)
    return _BUILT[key]


def _scan(docs: DataFrame, key: str, text: str, rows: list[tuple], how: tuple[int, int, int], ddl: str) -> DataFrame:
    sent, number = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

    def make():
        pieces = _pieces(number, sent.value, *how)

        def row(k, t):
            if t:
                for item, distance in pieces.matches(t).items():
                    yield k, item, distance

        return row

    return arrow_flat_map(docs.select(key, text), make, ddl)


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, window: int = WINDOW, errors: int = 0, words_per_error: int = 1, most_chars: int = MAX_ITEM_CHARS) -> DataFrame:
    """``key, item_key, distance``: every document with the items it holds a passage of.

    A passage is ``window`` consecutive words of an item, or the whole of a
    shorter one, within ``errors`` words inserted, dropped or changed (one for
    each ``words_per_error`` words at most, and never all);
    ``distance`` is the least number of these. Null and empty texts hold and
    are nothing. Documents are scanned without a shuffle. Items are broadcast
    after a check of their size: beyond ``most_chars`` they go in parts by hash
    of their key, one scan of the documents for each part. Parts are halved
    until none holds more, one item that is longer by itself aside.
    """
    chosen = items.select(item_key, item_text).dropna()
    chars = chosen.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0))).first()[0]
    parts = max(1, -(-chars // most_chars))
    while parts > 1:
        sizes = chosen.groupBy(F.pmod(F.xxhash64(item_key), F.lit(parts))).agg(F.sum(F.length(item_text)).alias("chars"), F.count(F.lit(1)).alias("n"))
        if not sizes.where(f"chars > {int(most_chars)} and n > 1").limit(1).count() or parts > MAX_PARTS:
            break
        parts *= 2
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    ddl = f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, distance int"
    each = [chosen.where(F.pmod(F.xxhash64(item_key), F.lit(parts)) == p) if parts > 1 else chosen for p in range(parts)]
    return reduce(DataFrame.unionByName, [_scan(docs, key, text, [tuple(r) for r in part.collect()], (window, errors, words_per_error), ddl) for part in each])
