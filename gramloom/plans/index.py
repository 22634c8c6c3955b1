"""Draw index: the model laid out for lookups, so that walk steps do not shuffle it."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from gramloom.operators.candidates import (
    HUB_FANOUT, ONE_SLOT, cumulative_ranges, draw_table, hub_states, one_slot_draws, sent_if_few,
    state_totals)
from gramloom.session import SORTED_FILES, open_files, stored, tidy

_STATES = "ord TINYINT, state_key STRING, total BIGINT, n_candidates BIGINT"
_DRAWS = ("ord TINYINT, state_key STRING, slot BIGINT, next_token STRING, "
          "count BIGINT, lo BIGINT, hi BIGINT")


STATE_ROWS = 1_000_000  # rows of a bucket of transitions dealt by state, on average, which a task sorts without a spill


def by_state(transitions: DataFrame, path: str) -> DataFrame:
    """The transitions, stored once below ``path`` clustered by (ord, state_key): sums, windows and joins by state move nothing.

    One order is dealt after the other, so the disk holds the shuffle of one at a time. The files are as small as the
    model's own, since each is sorted.
    """
    spark, state = transitions.sparkSession, ["ord", "state_key"]
    rows = transitions.select(*state, "next_token", "count")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // STATE_ROWS)
    table, mode = f"gramloom_{hashlib.md5(path.encode()).hexdigest()[:12]}_by_state", "overwrite"
    for order in sorted(r["ord"] for r in rows.select("ord").distinct().collect()) or [1]:
        dealt = rows.where(F.col("ord") == order).repartition(buckets, *state).sortWithinPartitions("state_key", "next_token")
        with tidy(spark), open_files(spark):
            (dealt.write.mode(mode).format("parquet").bucketBy(buckets, *state).options(**SORTED_FILES)
             .option("path", path).saveAsTable(table))
        mode = "append"
    return spark.table(table)


class DrawIndex:
    """Two bucketed tables below ``path``: ``states`` and ``draws``.

    Both are clustered by their lookup key, so a join with them moves only the other side,
    which is as large as the walks in flight, however large the model is.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._prefix = "gramloom_" + hashlib.md5(self.path.encode()).hexdigest()[:12]

    @classmethod
    def build(cls, transitions: DataFrame, path: str, buckets: int | None = None,
              hub_fanout: int = HUB_FANOUT, version: str = "") -> DrawIndex:
        """Write the index of a model's transitions (ord, state_key, next_token, count), which are read twice an order.

        ``version`` names the state of the model, such as its last batch. It is stored with the bucket count.
        """
        spark = transitions.sparkSession
        index = cls(spark, path, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        # One order after the other, so that the disk holds the shuffle of one at a time. Orders are at most 9. The
        # totals are dealt by their keys already, to as many tasks as there are buckets unless told otherwise.
        dealt, mode = index.buckets == int(spark.conf.get("spark.sql.shuffle.partitions")), "overwrite"
        orders = sorted(r["ord"] for r in transitions.select("ord").distinct().collect())
        for order in orders or [1]:
            index._write("states", state_totals(transitions.where(F.col("ord") == order)), ["ord", "state_key"], dealt, mode)
            mode = "append"
        # Reading the stored totals to see which states are large is cheap: the filter reaches Parquet. They are few, at
        # most one in ONE_SLOT rows. Only their transitions are shuffled twice, for the sums and then by slot.
        state, draws = ["ord", "state_key"], ["ord", "state_key", "slot"]
        large = stored(hub_states(index.states(), min(ONE_SLOT, hub_fanout)), "large")
        hubs = stored(hub_states(index.states(), hub_fanout), "hubs")
        with_large = {r["ord"] for r in large.select("ord").distinct().collect()}
        few, mode = sent_if_few(large), "overwrite"
        for order in orders or [1]:
            of_order = transitions.where(F.col("ord") == order)
            small = of_order.join(few, state, "left_anti") if order in with_large else of_order
            index._write("draws", one_slot_draws(small, index.buckets), draws, dealt=True, mode=mode)
            mode = "append"
            if order in with_large:
                ranges = cumulative_ranges(of_order.join(few, state, "left_semi"), None if hubs.isEmpty() else hubs)
                index._write("draws", draw_table(ranges), draws, mode=mode)
        (spark.range(1).select(F.lit(index.buckets).alias("buckets"), F.lit(version).alias("version"))
         .coalesce(1).write.mode("overwrite").parquet(f"{index.path}/about"))
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: str | None = None) -> DrawIndex:
        """Name the tables of an index written by an earlier session. A ``version`` other than the stored one is an error."""
        about = spark.read.schema("buckets int, version string").parquet(f"{path.rstrip('/')}/about").first()
        if version is not None and version != about["version"]:
            raise ValueError(f"the index is of version {about['version']!r}, not {version!r}")
        index, buckets = cls(spark, path, about["buckets"]), about["buckets"]
        for name, columns, keys in (("states", _STATES, "ord, state_key"), ("draws", _DRAWS, "ord, state_key, slot")):
            spark.sql(f"DROP TABLE IF EXISTS {index._table(name)}")  # an external table: its files stay
            spark.sql(
                f"CREATE TABLE {index._table(name)} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{index.path}/{name}'")
        return index

    def _table(self, name: str) -> str:
        return f"{self._prefix}_{name}"

    def _write(self, name: str, rows: DataFrame, keys: list[str], dealt: bool = False, mode: str = "overwrite") -> None:
        # The same hash places rows in shuffle partitions and in buckets: one file per bucket. A file is kept open for each
        # bucket of a task, so the rows are not sorted by bucket. Draws come in order from their window; totals are sorted
        # here, by state_key first, whose first bytes tell most rows apart.
        placed = rows if dealt else rows.repartition(self.buckets, *keys)
        if name == "states":
            placed = placed.sortWithinPartitions("state_key", "ord")
        with tidy(self.spark), open_files(self.spark):
            (placed.write.mode(mode).format("parquet").bucketBy(self.buckets, *keys).options(**SORTED_FILES)
             .option("path", f"{self.path}/{name}").saveAsTable(self._table(name)))

    def states(self, max_order: int | None = None) -> DataFrame:
        rows = self.spark.table(self._table("states"))
        return rows if max_order is None else rows.where(F.col("ord") <= max_order)

    def draws(self, max_order: int | None = None) -> DataFrame:
        rows = self.spark.table(self._table("draws"))
        return rows if max_order is None else rows.where(F.col("ord") <= max_order)
