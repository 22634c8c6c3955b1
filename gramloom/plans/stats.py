"""Named reports over a model and its step logs, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gramloom.functions.text import format_bytes
from gramloom.functions.tokens import END, START
from gramloom.operators.candidates import state_totals
from gramloom.operators.ranking import frequency_rank, running_total
from gramloom.plans.model import TransitionModel

ROW_OVERHEAD = 13  # fixed value: bytes added to a state's length in the size estimate


def zipf(vocabulary: DataFrame, limit: int = 30) -> DataFrame:
    """(token, freq, rank) of the most frequent words.

    The first rows suffice to rank themselves, so only a top-k crosses the network.
    """
    top = _real_words(vocabulary).orderBy(F.desc("freq"), "token").limit(limit)
    return frequency_rank(top.select("token", "freq"), "freq", "rank").orderBy("rank", "token")


def vocabulary_rank(vocabulary: DataFrame) -> DataFrame:
    """(token, freq, rank) of every word."""
    return frequency_rank(_real_words(vocabulary).select("token", "freq"), "freq", "rank")


def _real_words(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.where(~F.col("token").isin(START, END))


def backoff(steps: DataFrame) -> DataFrame:
    """(order_used, steps, pct) with a grand total in the row whose order is NULL."""
    per_order = steps.where(F.col("order_used").isNotNull()).groupBy("order_used").agg(
        F.count(F.lit(1)).alias("n"))
    total = per_order.agg(F.sum("n").alias("all_steps"))
    counted = per_order.rollup("order_used").agg(F.sum("n").alias("steps"))
    return counted.crossJoin(F.broadcast(total)).select(  # one row
        "order_used", "steps", F.round(F.lit(100.0).cast("double") * F.col("steps") / F.col("all_steps"), 1).alias("pct"),
    ).where(F.col("steps").isNotNull()).orderBy(F.asc_nulls_last("order_used"))


def perplexity(steps: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, tokens, avg_surprise_bits, perplexity); steps without a probability do not count."""
    surprise = -F.avg(F.log2("chosen_prob"))
    return (steps.where(F.col("chosen_prob").isNotNull()).groupBy(run)
            .agg(F.count(F.lit(1)).alias("tokens"), surprise.alias("s"))
            .select(run, "tokens", F.round("s", 3).alias("avg_surprise_bits"),
                    F.round(F.pow(F.lit(2.0), "s"), 2).alias("perplexity"))
            .orderBy(run))


def branch_entropy(transitions: DataFrame) -> DataFrame:
    """(ord, state_key, branches, entropy_bits) of every state with more than one branch.

    log2(T) - sum(c log2 c) / T needs one aggregation, where shares need a window first.
    """
    c = F.col("count")
    sums = transitions.groupBy("ord", "state_key").agg(
        F.count(F.lit(1)).alias("branches"), F.sum(c).alias("t"), F.sum(c * F.log2(c)).alias("clogc"))
    return sums.where(F.col("branches") > 1).select(
        "ord", "state_key", "branches",
        F.round(F.log2("t") - F.col("clogc") / F.col("t"), 3).alias("entropy_bits"))


def entropy(transitions: DataFrame, limit: int = 20) -> DataFrame:
    """The states that are hardest to continue."""
    return branch_entropy(transitions).orderBy(F.desc("entropy_bits"), "ord", "state_key").limit(limit)


def order_summary(transitions: DataFrame) -> DataFrame:
    """(ord, transitions, states): distinct states are grouped first, not listed per order."""
    return (state_totals(transitions).groupBy("ord")
            .agg(F.sum("n_candidates").alias("transitions"), F.count(F.lit(1)).alias("states"))
            .orderBy("ord"))


def model_totals(transitions: DataFrame) -> DataFrame:
    """(transitions, states) of the whole model."""
    return order_summary(transitions).agg(
        F.sum("transitions").alias("transitions"), F.sum("states").alias("states"))


def size(model: TransitionModel) -> DataFrame:
    """(ord, transitions, states, model_size, trained_on)."""
    per_order = state_totals(model.transitions()).groupBy("ord").agg(
        F.sum("n_candidates").alias("transitions"),
        F.count(F.lit(1)).alias("states"),
        F.sum((F.length("state_key") + ROW_OVERHEAD) * F.col("n_candidates")).alias("bytes"))
    names = (model.training_runs().join(
                 model.documents().select(F.col("id").alias("document_id"), "name"), "document_id")
             .select("ord", "name").distinct()
             .groupBy("ord").agg(
                 F.expr("listagg(name, ', ') WITHIN GROUP (ORDER BY name)").alias("trained_on")))
    return (per_order.join(names, "ord", "left")
            .select("ord", "transitions", "states", format_bytes(F.col("bytes")).alias("model_size"), "trained_on")
            .orderBy("ord"))


def trained_sources(model: TransitionModel) -> DataFrame:
    """(ord, name, times): the sources trained at each order, as rows, and how often."""
    names = model.documents().select(F.col("id").alias("document_id"), "name")
    return model.training_runs().join(names, "document_id").groupBy("ord", "name").agg(F.count(F.lit(1)).alias("times"))


def growth(model: TransitionModel) -> DataFrame:
    """(run, name, ord, ngrams_added, cumulative_ngrams) in training order."""
    names = model.documents().select(F.col("id").alias("document_id"), "name")
    runs = running_total(model.training_runs(), "id", "ngrams_added", "cumulative_ngrams")
    return runs.join(names, "document_id").select(
        F.col("id").alias("run"), "name", "ord", "ngrams_added", "cumulative_ngrams").orderBy("run")


def stats(model: TransitionModel, name: str, steps: DataFrame | None = None) -> DataFrame:
    """The report called ``name``; backoff and perplexity read ``steps``, or the model's own log of walks."""
    of_model = {
        "zipf": lambda: zipf(model.vocabulary()),
        "entropy": lambda: entropy(model.transitions()),
        "size": lambda: size(model),
        "growth": lambda: growth(model),
    }
    of_steps = {"backoff": backoff, "perplexity": perplexity}
    if name in of_model:
        return of_model[name]()
    if name in of_steps:
        return of_steps[name](steps if steps is not None else model.generation_steps())
    raise ValueError(f"unknown report '{name}'; available: {', '.join([*of_model, *of_steps])}")
