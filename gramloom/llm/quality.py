"""Quality rules: document statistics, a hard base rule, and gradient-boosted trees on the statistics.

Trees are grown level by level on binned statistics of a bounded labelled sample, with the second-order
gains of the logistic loss. Chosen statistics are monotone: a split whose leaf values run against the direction is
refused, and the mean of its two values bounds all leaves below, so more repetition or more symbols never raise
a score. The trees are flattened into numpy node arrays, and a batch of texts goes down all trees level by
level at once.

A null or empty text has no words: all statistics are 0, it fails the base rule and is not kept. Without labels of
both classes the verdict of the trees is to keep.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import WORD, over_texts, sample_of

SAMPLE = 6_000  # labelled documents of each class that the trees learn from, at most about
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64
SMALLEST_LEAF, PENALTY = 20.0, 1.0
MIN_WORDS, WINDOW = 20, 8
_WORDS = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that the trees see, and the direction in which they may move the score (0: either).
FEATURES = {
    "words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0,
    "upper_share": 0, "digit_share": 0, "letter_share": 0, "stops_per_word": 0, "commas_per_word": 0, "words_per_line": 0,
    "marks_per_word": 0, "most_common_share": -1,
}


def repeat_words(words: list[str]) -> int:
    """Words inside windows of eight words that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    with np.errstate(over="ignore"):
        codes = _mix(codes + np.uint64(1))
        hashes = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            hashes = _mix(hashes * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n])
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    cover[starts] += 1  # each start once
    cover[starts + WINDOW] -= 1
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The five counts of BASE, and the statistics of FEATURES."""
    words = _WORDS.findall(text)
    if not words:
        symbols = sum(map(text.count, _SYMBOLS))
        return [0, 0, symbols, 0, 0], [0.0] * len(FEATURES)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.split("\n") if _WORDS.search(line)] if "\n" in text else [text]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper = int(((codes >= 65) & (codes <= 90)).sum())
    lower = int(((codes >= 97) & (codes <= 122)).sum())
    digits = int(((codes >= 48) & (codes <= 57)).sum())
    beyond = int((codes >= 192).sum())
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    stops = text.count(".") + text.count("?") + text.count("!")
    return [n, chars, symbols, dup_lines, repeats], [
        float(n), chars / n, symbols / n, dup_lines / len(lines), repeats / n, len(distinct) / n, upper / chars, digits / chars,
        (upper + lower + beyond) / chars, stops / n, text.count(",") / n, n / len(lines), (text.count("!") + text.count("?")) / n,
        max(distinct.values()) / n]


@dataclass
class Trees:
    """Complete binary trees as arrays: node k has the children 2k+1 and 2k+2; leaves are numbered from the left."""

    feature: np.ndarray  # (trees, 2 ** depth - 1)
    threshold: np.ndarray  # a value at or below goes left
    leaf: np.ndarray  # (trees, 2 ** depth)
    start: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for each row, going down all trees level by level."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        inner = self.feature.shape[1]
        while inner and at.size and at[0, 0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        return self.start + self.leaf[trees, at - inner].sum(1)


def fit(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
        counts: np.ndarray | None = None) -> Trees:
    """Boosted trees for 0/1 labels. The lighter class gets the heavier weight, so that both count alike.

    With ``counts``, each row stands for as many equal ones, and the trees are those of the rows so repeated.
    """
    shares = np.linspace(0, 1, BINS)[1:-1]
    cuts = [np.unique(np.quantile(column, shares) if counts is None else _quantiles(column, counts, shares)) for column in x.T]
    counts = np.ones(len(y)) if counts is None else counts
    bins = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], 1)
    positive, negative = (counts * y).sum(), (counts * (1 - y)).sum()
    weight = np.where(y == 1, 0.5 / max(positive, 1), 0.5 / max(negative, 1)) * counts.sum() * counts
    margin, inner = np.zeros(len(y)), 2 ** depth - 1
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, 2 ** depth))
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(len(y), np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for node in range(inner):
            mine = np.flatnonzero(at == node)
            cut = _best_cut(bins[mine], g[mine], h[mine], counts[mine], cuts, directions, low[node], high[node])
            if cut is None:
                at[mine] = 2 * node + 1
                low[2 * node + 1:2 * node + 3], high[2 * node + 1:2 * node + 3] = low[node], high[node]
                continue
            f, b, middle = cut
            feature[tree, node], threshold[tree, node] = f, cuts[f][b]
            at[mine] = 2 * node + 1 + (bins[mine, f] > b)
            for child in (2 * node + 1, 2 * node + 2):
                low[child], high[child] = low[node], high[node]
            if directions[f]:
                up, down = (2 * node + 2, 2 * node + 1) if directions[f] > 0 else (2 * node + 1, 2 * node + 2)
                low[up], high[down] = middle, middle
        slots = at - inner
        sums_g, sums_h = np.bincount(slots, g, inner + 1), np.bincount(slots, h, inner + 1)
        value = np.clip(sums_g / (sums_h + PENALTY), low[inner:], high[inner:])
        leaf[tree] = rate * np.where(np.bincount(slots, minlength=inner + 1) > 0, value, 0.0)
        margin += leaf[tree][slots]
    return Trees(feature, threshold, leaf)


def _quantiles(column, counts, shares):
    """np.quantile of the column with each value as often as its count says."""
    order = np.argsort(column, kind="stable")
    values, upto = column[order], np.cumsum(counts[order])
    place = shares * (upto[-1] - 1)
    low, high = (values[np.searchsorted(upto, at, side="right")] for at in (np.floor(place), np.ceil(place)))
    return low + (high - low) * (place - np.floor(place))


def _best_cut(bins, g, h, counts, cuts, directions, low, high):
    """(feature, bin, middle of the two values) of the best gain, or None."""
    if counts.sum() < 2 * SMALLEST_LEAF:
        return None
    best, found = 1e-6, None
    total_g, total_h = g.sum(), h.sum()
    for f, edges in enumerate(cuts):
        n = len(edges) + 1
        if n < 2:
            continue
        left_g, left_h = (np.cumsum(np.bincount(bins[:, f], w, n))[:-1] for w in (g, h))
        count = np.cumsum(np.bincount(bins[:, f], counts, n))[:-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g ** 2 / (left_h + PENALTY) + right_g ** 2 / (right_h + PENALTY) - total_g ** 2 / (total_h + PENALTY)
        a = np.clip(left_g / (left_h + PENALTY), low, high)
        b = np.clip(right_g / (right_h + PENALTY), low, high)
        gain[(count < SMALLEST_LEAF) | (counts.sum() - count < SMALLEST_LEAF) | (directions[f] * (b - a) < 0)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = gain[k], (f, k, (a[k] + b[k]) / 2)
    return found


_STRUCT = pa.struct([(n, pa.int64()) for n in BASE] + [("x", pa.list_(pa.float64()))])


def statistics_of(text: Column) -> Column:
    """Struct of the counts of BASE and the array x of FEATURES."""

    def make():
        def one(text):
            counts, x = statistics(text or "")
            return dict(zip(BASE, counts), x=x)

        return lambda texts: pa.array([one(t) for t in texts], _STRUCT)

    return over_texts(make, "struct<" + ",".join(f"{n}:bigint" for n in BASE) + ",x:array<double>>")(text)


def learn(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """Trees from about SAMPLE documents of each class of ``labels`` (doc_id, quality), one row per document."""
    rows = sample_of(docs, labels, "quality", SAMPLE)
    seen = rows.select("doc_id", "quality", statistics_of(F.col("text")).alias("s"))
    seen = sorted(seen.select("doc_id", "quality", "s.x").collect())  # the same order on every run
    y = np.array([r["quality"] for r in seen], float)
    if not 0 < y.sum() < len(y):
        return None
    return fit(np.array([r["x"] for r in seen]), y, list(FEATURES.values()))


def judge(text: Column, trees: Trees | None) -> Column:
    """Struct of the counts of BASE, base_failed, score (0 to 1) and kept."""
    kind = pa.struct([(n, pa.int64()) for n in BASE] + [("base_failed", pa.bool_()), ("score", pa.float64()), ("kept", pa.bool_())])

    def make():
        def work(texts):
            rows = [statistics(t or "") for t in texts]
            if trees is None or not rows:
                score = np.ones(len(rows))
            else:
                score = 1 / (1 + np.exp(-trees.margin(np.array([x for _, x in rows]))))
            out = []
            for (counts, _), s in zip(rows, score):
                failed = counts[0] < MIN_WORDS or 100 * counts[4] > 30 * counts[0]
                out.append(dict(zip(BASE, counts), base_failed=failed, score=float(s), kept=not failed and bool(s >= 0.5)))
            return pa.array(out, kind)

        return work

    return over_texts(make, "struct<" + ",".join(f"{n}:bigint" for n in BASE) + ",base_failed:boolean,score:double,kept:boolean>")(text)
