"""How well a model foresees given text: the step log a walk along that text would leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gramloom.operators.backoff import backed_off
from gramloom.operators.candidates import ONE_SLOT, hub_states, sent_if_few
from gramloom.operators.lookup import lookup
from gramloom.operators.ngrams import CHUNK
from gramloom.session import by_part_of_the_keys, stored


def forced_steps(sents: DataFrame, transitions: DataFrame, states: DataFrame, k: int, keys: list[str],
                 draws: DataFrame | None = None) -> DataFrame:
    """(keys…, sent_no, pos, order_used, state_key, next_token, chosen_prob, n_candidates).

    One row per token after a sentence's first. The context backs off as in a walk. A token
    never seen after the context that fired has a NULL probability and is not smoothed;
    without any known context ``order_used`` is NULL too.

    With the ``draws`` of an index the counts of all states with one slot are looked up there, where the tokens come
    to the model. Of ``transitions``, only those of larger states are shuffled then.
    """
    place = [*keys, "sent_no", "pos"]
    positions = stored(_positions(sents, k, keys), "positions")  # read several times below, made once
    stepped = backed_off(positions, "history", states, k, place).drop("history")
    counts, state = transitions.select("ord", "state_key", "next_token", "count"), ["ord", "state_key"]
    if draws is None:
        scored = lookup(stepped, counts, [*state, "next_token"], place, how="left")
    else:
        n = F.col("n_candidates")
        small = stepped.where(n <= ONE_SLOT).withColumn("slot", F.when(n < 0, 1).otherwise(0).cast("long"))
        with by_part_of_the_keys(sents.sparkSession):
            scored = stored(lookup(small, draws.select(*state, "slot", "next_token", "count"), [*state, "slot", "next_token"],
                                   place, how="left", few=True).drop("slot"), "scored")
        scored = scored.unionByName(stepped.where(n.isNull()).withColumn("count", F.lit(None).cast("long")))
        large = stored(hub_states(states, ONE_SLOT), "large")
        orders = [r["ord"] for r in large.select("ord").distinct().collect()]  # at most 9
        if orders:
            of_large = counts.where(F.col("ord").isin(orders)).join(sent_if_few(large), state, "left_semi")
            scored = scored.unionByName(stored(lookup(
                stepped.where(n > ONE_SLOT), of_large, [*state, "next_token"], place, how="left"), "scored"))
    return scored.select(
        *place, F.col("ord").alias("order_used"), "state_key", "next_token",
        (F.col("count") / F.col("total")).alias("chosen_prob"), "n_candidates")


def _positions(sents: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """(keys…, sent_no, pos, history, next_token) with at most ``k`` tokens of history."""
    toks, size = F.col("toks"), F.size("toks")
    # Chunks that begin with the k tokens before their first position keep the exploded copy small.
    chunks = F.transform(
        F.sequence(F.lit(2), size, F.lit(CHUNK)),
        lambda s: F.struct(s.alias("at"), F.slice(toks, F.greatest(s - k, F.lit(1)), F.lit(CHUNK + k)).alias("c")))
    parts = sents.select(*keys, "sent_no", size.alias("size"), F.inline(chunks))
    skip = F.least(F.col("at") - 1, F.lit(k))
    end = F.least(F.col("at") + CHUNK - 1, F.col("size"))
    rows = parts.select(*keys, "sent_no", "at", "c", skip.alias("skip"), F.explode(F.sequence("at", end)).alias("pos"))
    here = F.col("pos") - F.col("at") + F.col("skip") + 1   # place of the token in its chunk
    first = F.greatest(here - k, F.lit(1))
    return rows.select(
        *keys, "sent_no", "pos", F.slice("c", first, here - first).alias("history"),
        F.get("c", here - 1).alias("next_token"))
