"""Mixing sources to target weights with soft membership. DataFrame expressions alone.

A classifier learnt from the labelled table gives every document a probability for each domain, from statistics of its text. Rates,
numbers of times that documents are to appear, are fitted so that the expected tokens of each domain,
sum(rate * tokens * probability), meet the targets: least squares over all documents with rates of at least 0, by projected
gradients. A pass sums the domains' tokens and the moments of the documents in play on the executors, and brings
home K + K * K numbers; the gradient, scaled by the moments, is one more step that every document replays on its
own probabilities. No state is kept per document, nothing is shuffled. Started at 1, the rates move no further than needed.

A document's rate becomes whole copies by a random number drawn from its id: the floor of their sum, so
expectations are kept. Null and empty texts have no tokens: they weigh nothing, and take the rate that their
probabilities give. Without labels of two domains every rate is 1. A target for a domain without documents is out of reach, and the
others come as near as they can.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 6_000  # labelled documents of each domain that the classifier learns from, at most about
PASSES, CLOSE = 25, 1e-6  # at most; share of all tokens by which domains may miss their targets
_SPACE = r"[\x20\x09-\x0D]+"
_KINDS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", ".", "!?")  # of characters, no character in two


def with_statistics(docs: DataFrame, text: Column, tokens: str, x: str) -> DataFrame:
    """The rows with the number of words (long) and an array of statistics of a text."""
    body = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(body, _SPACE), lambda w: w != "")
    # One pass gives every character of a kind the same mark; counting marks is a plain search for one byte.
    marks = F.translate(body, "".join(_KINDS), "".join(kind[0] * len(kind) for kind in _KINDS))
    lines = F.split(body, "\n")

    def shares(marks: Column, n: Column) -> list[Column]:
        return [(n - F.length(F.replace(marks, F.lit(kind[0]), F.lit("")))) / F.greatest(n, F.lit(1)) for kind in _KINDS]

    counted = F.transform(F.array(F.struct(words.alias("w"), marks.alias("m"), F.length(body).alias("c"))), lambda t: F.struct(
        F.size(t["w"]).alias("n"), F.size(F.array_distinct(t["w"])).alias("distinct"), t["m"].alias("m"), t["c"].alias("c")))
    counted = F.transform(counted, lambda t: F.struct(t["n"].cast("bigint").alias("n"), F.array(
        F.log1p(t["n"].cast("double")), t["distinct"] / F.greatest(t["n"], F.lit(1)), t["c"] / F.greatest(t["n"], F.lit(1)) / 10,
        *shares(t["m"], t["c"]),
        F.size(F.array_distinct(lines)) / F.size(lines)).alias("x")))
    row = "_counted"
    while row in docs.columns:
        row = "_" + row
    return docs.withColumn(row, F.element_at(counted, 1)).withColumn(tokens, F.col(row)["n"]).withColumn(x, F.col(row)["x"]).drop(row)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that a row computes once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


@dataclass
class Mixture:
    """Domains, the classifier's weights (a row per domain, the constant last), and the steps of the fit."""

    domains: list[str]
    weights: np.ndarray
    steps: list[list[float]] = field(default_factory=list)

    def probabilities(self, x: Column) -> Column:
        """Array of the domains' probabilities."""
        return _bound(x, self._probabilities)

    def _probabilities(self, x: Column) -> Column:
        scores = []
        for row in self.weights:
            score = F.lit(float(row[-1]))
            for i, w in enumerate(row[:-1]):
                score = score + x[i] * float(w)
            scores.append(score)
        raw = F.transform(F.array(*scores), lambda s: F.exp(F.greatest(F.least(s, F.lit(30.0)), F.lit(-30.0))))
        total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
        return _bound(raw, lambda e: _bound(total(e), lambda t: F.transform(e, lambda v: v / t)))

    def rate(self, p: Column) -> Column:
        """The rate that the steps so far give a document with these probabilities."""
        rate = F.lit(1.0)
        if not self.steps:
            return rate
        steps = F.array(*[F.array(*map(F.lit, step)) for step in self.steps])

        def moved(q: Column, r: Column, step: Column) -> Column:
            return F.greatest(F.lit(0.0), r - F.aggregate(F.zip_with(q, step, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))

        return _bound(p, lambda q: F.aggregate(steps, rate, lambda r, step: moved(q, r, step)))


def classifier(x: np.ndarray, y: np.ndarray, domains: list[str]) -> np.ndarray:
    """Weights of a softmax regression on standardised statistics, by Newton's method for each domain against the rest."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    data = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    rows = []
    for k in range(len(domains)):
        beta, hit = np.zeros(data.shape[1]), (y == k).astype(float)
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(data @ beta, -30, 30)))
            hessian = (data * (q * (1 - q))[:, None]).T @ data + np.eye(len(beta))
            beta = beta + np.clip(np.linalg.solve(hessian, data.T @ (hit - q) - beta), -3, 3)
        plain = beta[:-1] / scale
        rows.append(np.append(plain, beta[-1] - plain @ mean))
    return np.array(rows)


def learn(stated: DataFrame, labels: DataFrame) -> Mixture:
    """A classifier from rows (doc_id, x) and ``labels`` (doc_id, domain), about SAMPLE of each domain, chosen by hash."""
    counts = {r["domain"]: r["n"] for r in labels.where("domain is not null").groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(counts)
    if len(domains) < 2:
        return Mixture(domains, np.zeros((0, 0)))
    chosen = F.lit(False)
    for d in domains:
        chosen |= (F.col("domain") == d) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / counts[d]) * (1 << 30)))
    seen = stated.select("doc_id", "x").join(F.broadcast(labels.where(chosen).select("doc_id", "domain")), "doc_id").collect()
    seen.sort(key=lambda r: (r["doc_id"], r["x"]))
    present = {r["domain"] for r in seen}
    domains = [d for d in domains if d in present]
    if len(domains) < 2:
        return Mixture(domains, np.zeros((0, 0)))
    weights = classifier(np.array([r["x"] for r in seen]), np.array([domains.index(r["domain"]) for r in seen]), domains)
    return Mixture(domains, weights)


def fit(stated: DataFrame, mixture: Mixture, targets: dict[str, float], keep: tuple[str, ...] = ()) -> Mixture:
    """Add the steps that bring the domains to their target shares of all tokens, from rows (n_tokens, x).

    All tokens are as many as now, or more where a domain of ``keep`` would lose some otherwise.
    """
    if len(mixture.domains) < 2:
        return mixture
    size = len(mixture.domains)
    aim = np.array([targets.get(d, 0.0) for d in mixture.domains])
    aim = aim / aim.sum() if aim.sum() > 0 else np.full(size, 1 / size)
    rows = stated.select(F.col("n_tokens").cast("double").alias("n"), mixture.probabilities(F.col("x")).alias("p"))
    for turn in range(PASSES):
        now = rows.withColumn("r", mixture.rate(F.col("p")))
        sums = [F.sum("n").alias("n")] + [F.sum(F.col("n") * F.col("r") * F.col("p")[k]).alias(f"m{k}") for k in range(size)]
        sums += [F.sum(F.when(F.col("r") > 0, F.col("n") * F.col("p")[k] * F.col("p")[j])).alias(f"q{k}_{j}") for k in range(size) for j in range(k + 1)]
        got = now.agg(*sums).first()
        if not got["n"]:
            return mixture
        mass = np.array([got[f"m{k}"] for k in range(size)]) / got["n"]
        if turn == 0:
            for k, d in enumerate(mixture.domains):
                if d in keep and aim[k] > 0:
                    aim = aim * max(1.0, mass[k] / aim[k])
        miss = mass - aim
        if np.abs(miss).max() < CLOSE:
            break
        moments = np.array([[got[f"q{max(k, j)}_{min(k, j)}"] or 0.0 for j in range(size)] for k in range(size)]) / got["n"]
        mixture.steps.append([float(v) for v in np.linalg.solve(moments + 1e-9 * np.eye(size), miss)])
    return mixture


def copies(rate: Column, doc_id: Column) -> Column:
    """Whole copies whose expectation is the rate, the same on every run."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), doc_id), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(rate + draw).cast("int")


def mixed(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """The rows of docs, each as many times as its copies say, with the columns that docs has."""
    if len(mixture.domains) < 2:
        return docs
    names = docs.columns
    fresh = []
    for stem in ("tokens", "x", "copy"):
        while stem in names or stem in fresh:
            stem = "_" + stem
        fresh.append(stem)
    tokens, x, copy = fresh
    rows = with_statistics(docs, F.col("text"), tokens, x)
    times = copies(mixture.rate(mixture.probabilities(F.col(x))), F.col("doc_id"))
    # No copies are an empty array, which explode drops: a filter of its own would work the statistics out again.
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).select(*names)
