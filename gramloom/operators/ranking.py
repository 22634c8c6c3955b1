"""Numbering and running sums without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gramloom.functions.draws import hash_bucket


def offsets_by_bucket(rows: DataFrame, bucket: Column, amount: Column) -> DataFrame:
    """(bucket, before): the amounts in all earlier buckets.

    One task adds up one row per bucket; callers choose buckets of bounded number.
    """
    totals = rows.groupBy(bucket.alias("bucket")).agg(F.sum(amount).alias("in_bucket"))
    running = F.sum("in_bucket").over(Window.orderBy("bucket"))
    return totals.select("bucket", (running - F.col("in_bucket")).alias("before"))


def dense_ids(rows: DataFrame, key: str, id_name: str, start: int = 0) -> DataFrame:
    """Number the rows ``start + 1 …`` in the order of (md5 bucket of ``key``, ``key``).

    Keys are unique. 4,096 evenly filled buckets are sorted side by side, and each begins
    where the earlier ones end. The numbers depend on the values only, so a task that runs
    again after a lost executor gives the same ones.
    """
    bucketed = rows.withColumn("bucket", hash_bucket(F.col(key).cast("string")))
    before = offsets_by_bucket(bucketed, F.col("bucket"), F.lit(1).cast("long"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return (bucketed.withColumn("place", place)
            .join(F.broadcast(before), "bucket")  # at most 4,096 rows
            .withColumn(id_name, F.col("place") + F.col("before") + F.lit(start).cast("long"))
            .drop("bucket", "place", "before"))


def running_total(rows: DataFrame, order: str, amount: str, name: str, per_bucket: int = 65536) -> DataFrame:
    """Running sum of ``amount`` along the dense ids in ``order``."""
    bucketed = rows.withColumn("bucket", F.expr(f"({order} - 1) div {per_bucket}"))
    before = offsets_by_bucket(bucketed, F.col("bucket"), F.col(amount))
    inside = F.sum(amount).over(Window.partitionBy("bucket").orderBy(order))
    return (bucketed.withColumn("inside", inside)
            .join(before, "bucket")
            .withColumn(name, F.col("inside") + F.col("before"))
            .drop("bucket", "inside", "before"))


def frequency_rank(rows: DataFrame, freq: str, name: str) -> DataFrame:
    """RANK by falling ``freq``: 1 + the number of rows with a larger one.

    The rows are counted per distinct frequency first. Those counts are summed in buckets
    of like magnitude (a few hundred), so no task sorts the rows themselves.
    """
    per_freq = rows.groupBy(F.col(freq).alias("f")).agg(F.count(F.lit(1)).alias("m"))
    bucketed = per_freq.withColumn("bucket", -F.floor(F.log2("f") * 16))
    before = offsets_by_bucket(bucketed, F.col("bucket"), F.col("m"))
    falling = Window.partitionBy("bucket").orderBy(F.desc("f"))
    ranks = (bucketed.withColumn("inside", F.sum("m").over(falling) - F.col("m"))
             .join(before, "bucket")
             .select("f", (F.col("inside") + F.col("before") + 1).alias(name)))
    return joined_to_small(rows, ranks, F.col(freq), "f").drop("f")


BROADCAST_ROWS = 1_000_000  # rows of a small side sent to every task
SALTS = 64  # copies of a small side that is too large to send, for keys that hold many rows


def joined_to_small(rows: DataFrame, small: DataFrame, key: Column, small_key: str) -> DataFrame:
    """``rows`` inner-joined to ``small`` on key = small_key, without a task per hot key.

    The small side is counted first: up to ``BROADCAST_ROWS`` rows it goes to every task and nothing moves. Beyond,
    each row of ``rows`` gets a salt from a hash of all its columns, and ``small`` is copied once per salt, so a key
    that holds a third of the rows is spread over ``SALTS`` tasks.
    """
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), key == F.col(small_key))
    salt = "_salt"
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)))
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(copies, (key == F.col(small_key)) & (salted[salt] == copies[salt])).drop(salt)


HEAVY = 1000  # keys measured as hot, at most, whose matches go to every task


def joined_with_heavy_split(rows: DataFrame, other: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """``rows`` inner-joined to ``other`` on ``key``; the keys that hold many rows of ``rows`` do not meet in one task.

    The rows per key are counted first (partial sums before the shuffle). Keys with more than a share of
    1 / (4 * tasks) of all rows, at most ``HEAVY`` of them, are hot: their rows of ``other`` are sent to every task and
    joined in place. All other keys are joined by shuffle, so no task gets much more than its share.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = per_key.agg(F.sum("_rows").alias("n")).first()["n"] or 0
    hot = [r[key] for r in per_key.where(F.col("_rows") * 4 * tasks > total).orderBy(F.desc("_rows")).limit(HEAVY).collect()]
    if not hot:
        return rows.join(other, key)
    is_hot = F.col(key).isin(hot)
    return (rows.where(is_hot).join(F.broadcast(other.where(is_hot)), key)
            .unionByName(rows.where(~is_hot | F.col(key).isNull()).join(other.where(~is_hot), key)))
