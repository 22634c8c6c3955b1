"""The longest known context of a history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gramloom.operators.lookup import lookup
from gramloom.session import stored


def suffix_keys(rows: DataFrame, keep: list[str], history: str, longest: Column,
                shortest: Column | None = None) -> DataFrame:
    """(keep…, ord, state_key): the history's last ``ord`` tokens, for each order allowed."""
    first = F.lit(1) if shortest is None else shortest
    top = F.least(longest, F.size(history))
    orders = rows.where(top >= first).select(*keep, history, F.explode(F.sequence(first, top)).alias("ord"))
    return orders.select(
        *keep,
        F.col("ord").cast("tinyint").alias("ord"),
        F.array_join(F.slice(history, -F.col("ord"), F.col("ord")), " ").alias("state_key"),
    )


def longest_known(keys: DataFrame, states: DataFrame, row_id: list[str], few: bool = False) -> DataFrame:
    """(row_id…, state): per row, the known state of highest order, as a struct.

    ``states`` holds (ord, state_key) and what else the caller wants to know of a state.
    Rows none of whose suffixes is known are absent from the result.
    """
    found = lookup(keys, states, ["ord", "state_key"], row_id, few=few)
    facts = F.struct(*[F.col(c) for c in states.columns])
    return found.groupBy(*row_id).agg(F.max_by(facts, F.col("ord")).alias("state"))


def backed_off(rows: DataFrame, history: str, states: DataFrame, k: int, row_id: list[str]) -> DataFrame:
    """The rows, each with the columns of its longest known state of up to ``k`` tokens, as of :func:`longest_known`;
    they are NULL where no suffix is known.

    The orders are looked up one after the other, the longest first, and only rows without an answer ask the next. So
    few rows ask for several keys, and each answer is stored before the next is sought: the disk holds the shuffles of
    one order at a time. ``states`` is to be clustered by (ord, state_key); the rows come to it.
    """
    facts = [c for c in states.columns if c not in ("ord", "state_key")]
    known, left = [], rows
    for order in range(k, 0, -1):
        keys = suffix_keys(left.withColumn("_history", F.col(history)), rows.columns, "_history", F.lit(order), F.lit(order))
        asked = stored(lookup(keys, states.where(F.col("ord") == order).withColumn("_known", F.lit(True)), ["ord", "state_key"],
                              row_id, how="left", few=True), "known")
        known.append(asked.where("_known").select(*rows.columns, "ord", "state_key", *facts))
        left = left.where(F.size(history) < order).unionByName(asked.where("_known IS NULL").select(*rows.columns))
    kinds = dict(states.dtypes)
    every = left.select(*rows.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in ("ord", "state_key", *facts)])
    for part in known:
        every = every.unionByName(part)
    return every
