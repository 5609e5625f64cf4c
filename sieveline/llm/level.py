"""Problem 10: reading level by gradient-boosted regression trees.

Trees over distributions of length, vocabulary, syntax and cohesion are
trained on the labelled documents, cross-validated with whole sources left out,
and their out-of-fold predictions calibrate the borders between the levels.
"""

from __future__ import annotations

import math
import re
from statistics import median

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_flat_map

#: At most so many labelled documents train the trees; taken by hash, so the same ones every time.
MAX_LABELLED = 4000
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.15, 32, 8

# Function words of English, connectives, and endings of abstract nouns and technical words.
FUNCTION = frozenset("the of and a to in is it you that was for on are with as they be at one have this from or had by not but what all were when we there can an your which their if do will each about how up out them then so would into has more its who than only it's i he she his her my our".split())
CONNECTIVES = frozenset("although because whereas unless while whether since therefore however moreover nevertheless thus hence though whose whom which whoever whatever insofar provided despite notwithstanding lest until if that rather".split())
SUBORDINATORS = frozenset("which that whether whose whom although unless whoever because since while whereas if".split())
ABSTRACT = re.compile(r"(?:tion|sion|ment|ness|ity|ism|ance|ence|ency|ology|acy|ical|ative|ible|istic|ational|ously|ology)s?$")
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|\n\s*\n|(?<=[。！？])")
VOWELS = re.compile(r"[aeiouyàáâäèéêëìíîïòóôöùúûü]+", re.I)
CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")

NAMES = (
    "sentences words mean_words median_words p90_words max_words sd_words long_sentence_share short_sentence_share word_length long_word_share syllables abstract_share median_abstract "
    "function_share connective_share subordinators_per_sentence median_subordinators commas_per_sentence semicolons_per_sentence and_share distinct_share overlap "
    "word_length_in_long long_words_in_long demanding_share plain_share"
).split()


def is_english(text: str) -> bool:
    """By the text alone: mostly Latin letters, and function words of English among the words."""
    words = WORD.findall(text.lower())
    if len(words) < 5 or not text.isascii() and len(CJK.findall(text)) * 4 > len(text):
        return False
    return sum(map(FUNCTION.__contains__, words)) >= 0.12 * len(words)


class _Words(dict):
    """What is known of a word: length, long, syllables, abstract, function word, connective, subordinator."""

    def __missing__(self, w: str) -> tuple:
        if len(self) > 300_000:
            self.clear()
        n = len(w)
        known = self[w] = (n, n >= 8, len(VOWELS.findall(w)), ABSTRACT.search(w) is not None, w in FUNCTION, w in CONNECTIVES, w in SUBORDINATORS)
        return known


_WORDS = _Words()


def _quantile(values: list[float], q: float) -> float:
    ordered = sorted(values)
    return ordered[min(len(ordered) - 1, int(q * len(ordered)))]


def sentences_of(text: str) -> list[list[str]]:
    """Words of each sentence; lines wrapped inside a sentence are joined, headings of few words left out."""
    out = []
    for block in re.split(r"\n\s*\n", text):
        lines = block.split("\n")
        joined = [lines[0]]
        for line in lines[1:]:
            last = joined[-1].rstrip()
            if last and last[-1] not in ".!?…:;。！？" and len(last) >= 45 and line[:1].strip():
                joined[-1] = last + " " + line
            else:
                joined.append(line)
        for line in joined:
            for s in SENTENCE.split(line):
                words = WORD.findall(s)
                if words and not (len(words) < 6 and s.strip()[-1:] not in ".!?…"):
                    out.append(words)
    return out


def features(text: str) -> list[float] | None:
    """The numbers of ``NAMES``; None for a text without a sentence."""
    sents = sentences_of(text.lower())
    if not sents:
        return None
    words = [w for s in sents for w in s]
    n, lengths = len(words), [len(s) for s in sents]
    mean = n / len(sents)
    per, sums = [], [0] * 6
    long_chars = long_words = long_long = 0
    for s in sents:
        columns = [sum(x) for x in zip(*map(_WORDS.__getitem__, s))]
        per.append((columns[3] / len(s), columns[6], columns[0] / len(s)))
        sums = [a + b for a, b in zip(sums, columns)]
        if len(s) >= 25:
            long_chars, long_words, long_long = long_chars + columns[0], long_words + len(s), long_long + columns[1]
    overlaps = []
    content = [{w for w in s if len(w) > 3} for s in sents]
    for a, b in zip(content, content[1:]):
        overlaps.append(len(a & b) / max(1, min(len(a), len(b))))
    demanding = sum(len(s) for s, (a, sub, wl) in zip(sents, per) if len(s) >= 22 and sub >= 2 and wl >= 4.3)
    plain = sum(x for x in lengths if x <= 20)
    return [
        len(sents), n, mean, median(lengths), _quantile(lengths, 0.9), max(lengths), math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths)),
        sum(x for x in lengths if x >= 30) / n, sum(x for x in lengths if x <= 8) / n,
        sums[0] / n, sums[1] / n, sums[2] / n, sums[3] / n, median(a for a, _, _ in per),
        sums[4] / n, sums[5] / n, sum(x for _, x, _ in per) / len(sents), median(x for _, x, _ in per),
        text.count(",") / len(sents), text.count(";") / len(sents), words.count("and") / n, len(set(words)) / n, sum(overlaps) / len(overlaps) if overlaps else 0.0,
        long_chars / long_words if long_words else 0.0, long_long / long_words if long_words else 0.0, demanding / n, plain / n,
    ]


class Trees:
    """Gradient-boosted regression trees for squared loss on binned features."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.n, self.depth, self.rate = trees, depth, rate
        self.base, self.forest = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        self.base = float(y.mean())
        now = np.full(len(y), self.base)
        self.forest = []
        for _ in range(self.n):
            tree: list = []
            self._grow(tree, binned, y - now, np.arange(len(y)), cuts, self.depth, now)
            self.forest.append(tree)
        return self

    def _grow(self, tree, binned, gap, rows, cuts, depth, now) -> int:
        """Adds the node for ``rows`` to ``tree`` and returns its place; leaves update the fit in ``now``."""
        at = len(tree)
        tree.append(None)
        best = (1e-9, -1, -1)
        if depth and len(rows) >= 2 * LEAF:
            total, count = gap[rows].sum(), len(rows)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                k = binned[rows, j]
                sums = np.bincount(k, gap[rows], len(c) + 1).cumsum()[:-1]
                counts = np.bincount(k, minlength=len(c) + 1).cumsum()[:-1]
                ok = (counts >= LEAF) & (count - counts >= LEAF)
                gain = np.where(ok, sums**2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(count - counts, 1) - total**2 / count, 0)
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (float(gain[b]), j, b)
        if best[1] < 0:
            value = self.rate * float(gap[rows].mean()) if len(rows) else 0.0
            now[rows] += value
            tree[at] = (-1, value, 0, 0)
            return at
        _, j, b = best
        left = binned[rows, j] <= b
        low = self._grow(tree, binned, gap, rows[left], cuts, depth - 1, now)
        high = self._grow(tree, binned, gap, rows[~left], cuts, depth - 1, now)
        tree[at] = (j, float(cuts[j][b]), low, high)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array([self.one(row) for row in x])

    def one(self, row) -> float:
        out = self.base
        for tree in self.forest:
            j, value, low, high = tree[0]
            while j >= 0:
                j, value, low, high = tree[low if row[j] <= value else high]
            out += value
        return out


def border(predicted: np.ndarray, above: np.ndarray) -> float:
    """The cut on the predictions with the best F1 for ``above``, in the middle of the gap it lies in."""
    order = np.argsort(-predicted)
    hits = np.cumsum(above[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + max(1, above.sum()))
    k = int(f1.argmax())
    lower = predicted[order[k + 1]] if k + 1 < len(order) else predicted[order[k]] - 0.5
    return float((predicted[order[k]] + lower) / 2)


def borders_of(predicted: np.ndarray, levels_: np.ndarray) -> tuple[float, float]:
    """The calibrated borders of levels 2 and 3."""
    low = border(predicted, levels_ >= 2) if (levels_ >= 2).any() and (levels_ < 2).any() else 1.5
    high = border(predicted, levels_ >= 3) if (levels_ >= 3).any() and (levels_ < 3).any() else 2.5
    return low, max(low, high)


class LevelModel:
    """The trees with the calibrated borders of levels 2 and 3, and what cross-validation said."""

    def __init__(self, trees: Trees, borders: tuple[float, float], accuracy: float, folds: int):
        self.trees, self.borders, self.accuracy, self.folds = trees, borders, accuracy, folds

    def score(self, text: str | None) -> tuple[float, int] | None:
        """Score and level; None for a null or empty text, one without English, or a stub of one line with few words."""
        if not text or not is_english(text):
            return None
        x = features(text)
        if x is None:
            return None
        s = self.trees.one(x)
        return s, 1 + (s > self.borders[0]) + (s > self.borders[1])


def train(docs: DataFrame, key: str, text: str, source: str, labels: DataFrame, level: str, limit: int = MAX_LABELLED, folds: int = 5) -> LevelModel:
    """Fits the trees on at most ``limit`` labelled English documents.

    Documents of one source are all in one fold. Without any labelled document
    of a level that level is never given.
    """
    chosen = labels.select(F.col(key), F.col(level).alias("_level")).dropna().dropDuplicates([key]).orderBy(F.xxhash64(key), key).limit(limit)
    known = docs.select(key, F.col(text).alias("_text"), F.coalesce(F.col(source), F.lit("")).alias("_source")).join(chosen, key)

    def make():
        def row(k, t, s, y):
            if t and is_english(t) and (x := features(t)) is not None:
                yield s.strip().lower().removeprefix("www."), float(y), x

        return row

    got = arrow_flat_map(known.select(key, "_text", "_source", F.col("_level").cast("double")), make, "source string, y double, x array<double>").collect()
    got.sort(key=lambda r: (r.source, r.y, r.x))
    if not got:
        return LevelModel(Trees(0).fit(np.zeros((1, 1)), np.array([2.0])), (1.5, 2.5), 0.0, 0)
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got])
    names = sorted({r.source for r in got})
    fold_of = {s: i % folds for i, s in enumerate(names)}
    fold = np.array([fold_of[r.source] for r in got])
    out = np.full(len(y), np.nan)
    for f in range(folds):
        test = fold == f
        if test.any() and (~test).sum() >= 2 * LEAF:
            out[test] = Trees().fit(x[~test], y[~test]).predict(x[test])
    seen = ~np.isnan(out)
    if not seen.any():
        out, seen = np.full(len(y), y.mean()), np.ones(len(y), bool)
    low, high = borders_of(out[seen], y[seen])
    # each fold is judged by borders that the other folds set
    hits = []
    for f in sorted(set(fold[seen])):
        test, rest = seen & (fold == f), seen & (fold != f)
        if rest.any():
            a, b = borders_of(out[rest], y[rest])
            hits.append((1 + (out[test] > a) + (out[test] > b)) == y[test])
    accuracy = float(np.mean(np.concatenate(hits))) if hits else float(np.mean((1 + (out[seen] > low) + (out[seen] > high)) == y[seen]))
    return LevelModel(Trees().fit(x, y), (low, high), accuracy, len(set(fold)))


def levels(docs: DataFrame, key: str, text: str, model: LevelModel) -> DataFrame:
    """``key, level, score``; null in both for texts that have no reading level (see ``LevelModel.score``). No shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def row(k, t):
            got = model.score(t)
            yield (k, None, None) if got is None else (k, int(got[1]), float(got[0]))

        return row

    return arrow_flat_map(docs.select(key, text), make, f"`{key}` {kind}, level int, score double")
