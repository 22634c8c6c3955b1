"""n-grams of token arrays, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

CHUNK = 64  # start positions per chunk; a chunk also holds the tokens that follow its last start


def chunked(rows: DataFrame, keys: list[str], overlap: int, chunk: int = CHUNK) -> DataFrame:
    """Cut ``toks`` into chunks of ``chunk`` start positions: (keys…, c, length).

    Exploding positions copies the array into every row, which is quadratic in the array's
    length. Chunks bound that copy for texts without sentence ends. Each start position is
    in one chunk only; ``overlap`` further tokens follow so that its n-grams are whole.
    ``length`` is the full array's size in the first chunk and NULL in the others.
    """
    toks = F.col("toks")
    length = F.coalesce(F.when(toks.isNotNull(), F.size(toks)), F.lit(0))
    whole = F.array(F.struct(toks.alias("c"), length.alias("length")))
    pieces = F.transform(
        F.sequence(F.lit(1), length, F.lit(chunk)),
        lambda s: F.struct(
            F.slice(toks, s, chunk + overlap).alias("c"), F.when(s == 1, length).alias("length")),
    )
    return rows.select(*keys, F.inline(F.when(length <= chunk, whole).otherwise(pieces)))


def ngrams(rows: DataFrame, orders: range, keys: list[str] = [], chunk: int = CHUNK) -> DataFrame:
    """(keys…, ord, state_key, next_token) for every order at once, without a shuffle."""
    lowest, width = orders.start, len(orders)
    parts = chunked(rows, keys, orders.stop - 1, chunk)
    starts = F.least(F.size("c"), F.lit(chunk))
    slots = parts.where(starts > 0).select(
        *keys, "c", F.explode(F.sequence(F.lit(0), starts * width - 1)).alias("j"))
    placed = slots.select(
        *keys, "c",
        F.expr(f"int(j div {width}) + 1").alias("i"),
        (F.col("j") % width + lowest).alias("ord"),
    ).where(F.col("i") + F.col("ord") <= F.size("c"))
    return placed.select(
        *keys,
        F.col("ord").cast("tinyint").alias("ord"),
        F.array_join(F.slice("c", F.col("i"), F.col("ord")), " ").alias("state_key"),
        F.get("c", F.col("i") + F.col("ord") - 1).alias("next_token"),
    )


def window_ngrams(tokens: DataFrame, order: int, *keys: str) -> DataFrame:
    """The same n-grams from positioned tokens, by a sliding window within a sentence.

    Takes a shuffle and a sort that :func:`ngrams` does not need; kept as the independent
    formulation to check it against.
    """
    by_position = Window.partitionBy(*keys).orderBy("pos")
    frame = by_position.rowsBetween(0, order - 1)
    spans = tokens.select(
        F.array_join(F.collect_list("token").over(frame), " ").alias("state_key"),
        F.lead("token", order).over(by_position).alias("next_token"),
        F.count(F.lit(1)).over(frame).alias("span"),
    )
    return spans.where(F.col("next_token").isNotNull() & (F.col("span") == order)).select(
        F.lit(order).cast("tinyint").alias("ord"), "state_key", "next_token")


def count_transitions(grams: DataFrame) -> DataFrame:
    """(ord, state_key, next_token, count); counts are summed on the map side first."""
    return grams.groupBy("ord", "state_key", "next_token").agg(F.count(F.lit(1)).alias("count"))


def ngrams_added(sents: DataFrame, orders: range, *keys: str) -> DataFrame:
    """(keys…, ord, ngrams_added) from sentence lengths alone, no n-gram is built."""
    per_order = [F.sum(F.greatest(F.size("toks") - k, F.lit(0))).alias(f"o{k}") for k in orders]
    wide = sents.groupBy(*keys).agg(*per_order)
    stacked = F.array(*[
        F.struct(F.lit(k).cast("tinyint").alias("ord"), F.col(f"o{k}").alias("ngrams_added")) for k in orders])
    return wide.select(*keys, F.inline(stacked))
