"""Toxic passages by maximum-scoring segment search.

Learning: every word of a labelled document stands for itself and for its beginnings of three letters and more.
Each such unit has a share of toxic documents, its Dirichlet prior being the share of the next shorter
unit, so that rare and unseen forms of a word inherit from their stem. A word scores the log-odds of the longest
unit known, less a drift that makes neutral text score below zero.

Search: one linear scan over the scores of a text finds every maximal scoring segment (Ruzzo and Tompa,
1999). Segment scores of neutral text follow an extreme-value law (Karlin and Altschul, 1990), so a segment of
score s in n words has the expectation E = K n exp(-lambda s) of arising by chance. A logistic curve
over the logarithms of these expectations, fitted on the learning rows, gives the score of the text.

Null and empty texts, and texts without words, have no segment: they score as the best clean text does.
Without labelled rows of both classes every text scores 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import over_texts, sample_of

SAMPLE = 6_000  # documents of each class that the model learns from, at most about
SHORTEST, LONGEST = 3, 12  # letters of the beginnings
PRIOR = 2.0  # weight of the shorter unit's share, in documents
BEYOND_CHANCE = 3.3  # signed root of the likelihood ratio; one unit in two thousand exceeds it by chance
DRIFT = 0.08
SIGNIFICANT = 0.01  # expectation below which a segment counts
CACHED_WORDS = 1 << 16  # some 8 MB a Python worker
_WORD = re.compile(r"[^\W\d_]+")
_SCHEMA = "struct<score:double,passages:array<struct<start:int,end:int,score:double,expected:double>>>"


@dataclass
class Model:
    units: dict[str, float]  # log-odds of beginnings and words that differ from their shorter unit
    scale: float = 1.0  # lambda
    search_space: float = 0.1  # K
    slope: float = 0.0
    intercept: float = -20.0


class Scores(dict):
    """Log-odds of words, less the drift, found when first asked for."""

    def __init__(self, units: dict[str, float]):
        super().__init__()
        self.units = units

    def __missing__(self, word: str) -> float:
        odds = self.units.get(word + " ")
        n = min(len(word), LONGEST)
        while odds is None and n >= SHORTEST:
            odds, n = self.units.get(word[:n]), n - 1
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = (odds or 0.0) - DRIFT
        return self[word]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, past the last, score), in one pass over the positive positions.

    Each candidate keeps the sums before and after it. A new one is joined to the nearest earlier candidate that
    begins lower, if that one ends lower too, until none does.
    """
    after = np.cumsum(scores)
    found: list[tuple[int, int, float, float]] = []  # first, past, sum before, sum after
    lower: list[int] = []  # for each candidate, the nearest earlier one that begins lower, or -1
    for at in np.flatnonzero(scores > 0):
        first, before, end = int(at), float(after[at] - scores[at]), float(after[at])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = lower[j]
            if j < 0 or found[j][3] >= end:
                found.append((first, int(at) + 1, before, end))
                lower.append(j)
                break
            first, before = found[j][0], found[j][2]
            del found[j:], lower[j:]
    return [(a, b, end - before) for a, b, before, end in found]


def _evidence(own: Scores, model: Model, text: str):
    """Words, segments with expectations, and the evidence: summed -log E of significant segments, else the best -log E."""
    words = _WORD.findall(text.lower())
    if not words:
        return 0, [], 0.0
    scores = np.fromiter(map(own.__getitem__, words), np.float64, len(words))
    if scores.max() <= 0:
        return len(words), [], 0.0
    space = model.search_space * len(words)
    rows = [(a, b, s, space * float(np.exp(-model.scale * s))) for a, b, s in segments(scores)]
    logs = [-np.log(max(e, 1e-300)) for *_, e in rows]
    strong = sum(x for x in logs if x > -np.log(SIGNIFICANT))
    return len(words), rows, max(0.0, strong if strong else max(logs))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from about SAMPLE documents of each class of ``labels`` (doc_id, toxic), one row per document."""
    rows = sample_of(docs, labels, "toxic", SAMPLE)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({})

    @F.arrow_udf("array<string>")
    def units_of(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            words = set(_WORD.findall(text.lower()))
            found = {w + " " for w in words}
            found |= {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
            out.append(list(found))
        return pa.array(out, pa.list_(pa.string()))

    table = (rows.select("toxic", F.explode(units_of("text")).alias("unit"))
             .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).where("n >= 4"))
    # Home come the units that are toxic beyond chance, and their extensions that are not.
    table = table.withColumn("root", _root(F.col("toxic"), F.col("n"), sizes[1] / (sizes[0] + sizes[1])))
    strong = [(r["unit"], r["toxic"], r["n"]) for r in table.where(F.col("root") > BEYOND_CHANCE).select("unit", "toxic", "n").collect()]
    if not strong:
        return Model({})
    kept = rows.sparkSession.createDataFrame([(u,) for u, *_ in strong], "known string")
    weak = table.where(F.col("root") <= BEYOND_CHANCE).join(F.broadcast(kept), F.expr("left(unit, length(unit) - 1)") == F.col("known"))
    strong += [(r["unit"], r["toxic"], r["n"]) for r in weak.select("unit", "toxic", "n").collect()]
    units = _odds([(u, toxic, n - toxic) for u, toxic, n in strong], sizes[1], sizes[0])
    model = Model(units)

    # The extreme-value law and the logistic curve, from the same bounded sample.
    law = rows.select("toxic", over_texts(lambda: _best_of(model), "struct<n:int,most:double,grown:array<double>>")(F.col("text")).alias("r"))
    seen = law.select("toxic", "r.*").where("n > 0").collect()
    clean = [r for r in seen if r["toxic"] == 0]
    words = sum(r["n"] for r in clean)
    means = np.array([r["grown"] for r in clean]).T @ np.array([r["n"] for r in clean]) / words if clean else None
    model.scale = _lambda_of(means)
    # P(no segment beyond s in n words) = exp(-K n exp(-lambda s)); K by maximum likelihood over clean documents
    model.search_space = max(1e-6, len(clean) / max(1e-9, sum(
        r["n"] * np.exp(-model.scale * max(0.0, r["most"])) for r in clean)))
    evidence = rows.select("toxic", over_texts(lambda: _evidence_only(model), "double")(F.col("text")).alias("x")).collect()
    x, y = np.array([r["x"] for r in evidence]), np.array([r["toxic"] for r in evidence], float)
    model.slope, model.intercept = _logistic(x, y)
    return model


_GRID = np.linspace(0.05, 2.0, 40)


def _best_of(model: Model):
    own = Scores(model.units)

    def work(texts):
        out = []
        for text in texts:
            words = _WORD.findall(text.lower())
            scores = np.fromiter(map(own.__getitem__, words), np.float64, len(words))
            most = max((s for *_, s in segments(scores)), default=0.0) if len(words) else 0.0
            grown = [float(np.exp(g * scores).mean()) for g in _GRID] if len(words) else [1.0] * len(_GRID)
            out.append({"n": len(words), "most": most, "grown": grown})
        return pa.array(out, pa.struct([("n", pa.int32()), ("most", pa.float64()), ("grown", pa.list_(pa.float64()))]))

    return work


def _evidence_only(model: Model):
    own = Scores(model.units)
    return lambda texts: pa.array([float(_evidence(own, model, t)[2]) for t in texts], pa.float64())


def _lambda_of(means: np.ndarray | None) -> float:
    """lambda > 0 with mean(exp(lambda * score)) = 1 over clean words: the largest grid value below one."""
    if means is None:
        return 1.0
    below = _GRID[means <= 1.0]
    return float(below.max()) if len(below) else float(_GRID[0])


def _odds(rows: list[tuple[str, int, int]], toxic_docs: int, clean_docs: int) -> dict[str, float]:
    """Log-odds of units, shortest first, each shrunk towards the unit before it.

    Kept are units whose odds are above zero beyond chance, and zeros for those that take back what a kept
    beginning would say.
    """
    half = (toxic_docs + clean_docs) / 2
    share: dict[str, float] = {}
    odds: dict[str, float] = {}
    for unit, toxic, clean in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        a, b = toxic * half / toxic_docs, clean * half / clean_docs
        s = (a + PRIOR * share.get(unit[:-1], 0.5)) / (a + b + PRIOR)
        share[unit] = s = min(max(s, 0.001), 0.999)
        value = math.log(s / (1 - s))
        if _root_of_ratio(toxic, clean, toxic_docs / (toxic_docs + clean_docs)) > BEYOND_CHANCE:
            odds[unit] = max(0.0, value)
        elif value < 0.5 * odds.get(unit[:-1], 0.0):
            odds[unit] = max(0.0, value)
        elif unit[:-1] in odds:
            odds[unit] = odds[unit[:-1]]
    return odds


def _root(toxic: Column, n: Column, share: float) -> Column:
    """Signed root of the log-likelihood ratio of counts against the share of toxic documents."""

    def part(k: Column, p: float) -> Column:
        return F.when(k > 0, 2 * k * F.log(k / (n * p))).otherwise(0.0)

    return F.signum(toxic - n * share) * F.sqrt(F.greatest(part(toxic, share) + part(n - toxic, 1 - share), F.lit(0.0)))


def _root_of_ratio(toxic: int, clean: int, share: float) -> float:
    n = toxic + clean
    ratio = sum(2 * k * math.log(k / (n * p)) for k, p in ((toxic, share), (clean, 1 - share)) if k)
    return math.copysign(math.sqrt(max(0.0, ratio)), toxic - n * share)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, both classes of equal weight, with a small penalty on the slope."""
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    x = np.minimum(x, 50.0)
    data, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(data @ beta, -30, 30)))
        gradient = data.T @ (weight * (y - p)) - np.array([0.01, 0.001]) * beta
        hessian = (data * (weight * p * (1 - p))[:, None]).T @ data + np.diag([0.01, 0.001])
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(max(beta[0], 0.0)), float(beta[1])


def score(text: Column, model: Model) -> Column:
    """Struct of score (0 to 1) and passages: significant segments with code point offsets, score and expectation."""

    def make():
        own = Scores(model.units)
        kind = pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])))])

        def one(text):
            _, rows, x = _evidence(own, model, text or "")
            strong = [r for r in rows if r[3] < SIGNIFICANT]
            passages = []
            if strong:
                spans = [m.span() for m in _WORD.finditer(text)]
                if len(spans) == len(_WORD.findall(text.lower())):
                    passages = [{"start": spans[a][0], "end": spans[b - 1][1], "score": s, "expected": e} for a, b, s, e in strong]
            p = 1 / (1 + np.exp(-np.clip(model.slope * min(x, 50.0) + model.intercept, -30, 30)))
            return {"score": float(p) if model.slope else 0.0, "passages": passages}

        return lambda texts: pa.array([one(t) for t in texts], kind)

    return over_texts(make, _SCHEMA)(text)
