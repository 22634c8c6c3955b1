"""States, their candidates' cumulative ranges, and a table to draw from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gramloom.functions.draws import hash_bucket

HUB_FANOUT = 100_000   # states with more candidates are summed in buckets, not in one task
PER_SLOT = 16          # candidates per draw slot, on average
ONE_SLOT = 1000        # states with at most this many candidates have a single slot
MAX_SLOTS = 65_536     # bound on the slots one candidate can cover
STATES_SENT = 200_000  # named states up to this many are sent to the transitions, which then stay where they are


def state_totals(transitions: DataFrame) -> DataFrame:
    """(ord, state_key, total, n_candidates)."""
    return transitions.groupBy("ord", "state_key").agg(
        F.sum("count").alias("total"), F.count(F.lit(1)).alias("n_candidates"))


def next_distribution(transitions: DataFrame, states: DataFrame) -> DataFrame:
    """(ord, state_key, next_token, count, prob, n_candidates).

    ``states`` comes from :func:`state_totals`; its partial sums shrink hub states before
    the shuffle, and AQE splits a hub's rows in the join.
    """
    return transitions.join(states, ["ord", "state_key"]).select(
        "ord", "state_key", "next_token", "count",
        (F.col("count") / F.col("total")).alias("prob"), "n_candidates")


def hub_states(states: DataFrame, hub_fanout: int = HUB_FANOUT) -> DataFrame:
    """(ord, state_key) with more than ``hub_fanout`` candidates: at most rows / ``hub_fanout``."""
    return states.where(F.col("n_candidates") > hub_fanout).select("ord", "state_key")


def sent_if_few(states: DataFrame) -> DataFrame:
    """Stored states, to be sent to all tasks of a join if they are few; beyond ``STATES_SENT`` Spark chooses the join."""
    return F.broadcast(states) if states.count() <= STATES_SENT else states


def cumulative_ranges(transitions: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """Add ``lo``, ``hi``, ``total``, ``n_candidates``: candidate ranges that tile [0, total).

    Candidates of a state stand in the order (md5 bucket of the token, token). One window
    sums a state's candidates. The states in ``hubs`` are windowed per md5 bucket instead,
    and each bucket begins where the earlier ones end, so that no task sorts a whole hub.
    Both ways give the same ranges; naming hubs only moves work.
    """
    state = ["ord", "state_key"]
    bucketed = transitions.withColumn("bucket", hash_bucket(F.col("next_token")))
    if hubs is None:
        return _windowed(bucketed, state).drop("bucket")
    plain = _windowed(bucketed.join(hubs, state, "left_anti"), state).drop("bucket")

    hub_rows = bucketed.join(hubs, state, "left_semi")
    parts = hub_rows.groupBy(*state, "bucket").agg(
        F.sum("count").alias("in_part"), F.count(F.lit(1)).alias("n_part"))
    whole = Window.partitionBy(*state)          # at most 4,096 rows per hub
    before = parts.select(
        *state, "bucket",
        (F.sum("in_part").over(whole.orderBy("bucket")) - F.col("in_part")).alias("before"),
        F.sum("in_part").over(whole).alias("hub_total"),
        F.sum("n_part").over(whole).alias("hub_candidates"),
    )
    hub = _windowed(hub_rows, [*state, "bucket"]).join(before, [*state, "bucket"]).select(
        *state, "next_token", "count",
        (F.col("before") + F.col("lo")).alias("lo"), (F.col("before") + F.col("hi")).alias("hi"),
        F.col("hub_total").alias("total"), F.col("hub_candidates").alias("n_candidates"))
    return plain.unionByName(hub)


def _windowed(rows: DataFrame, group: list[str]) -> DataFrame:
    inside = Window.partitionBy(*[c for c in group if c != "ord"], "ord")  # the sort begins with what tells most rows apart
    upto = F.sum("count").over(
        inside.orderBy("bucket", "next_token").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "ord", "state_key", "bucket", "next_token", "count",
        (upto - F.col("count")).alias("lo"), upto.alias("hi"),
        F.sum("count").over(inside).alias("total"), F.count(F.lit(1)).over(inside).alias("n_candidates"))


def slot_count(n_candidates):
    """How many equal slots a state's range is cut into."""
    return F.when(n_candidates <= ONE_SLOT, F.lit(1)).otherwise(
        F.least(F.ceil(n_candidates / PER_SLOT), F.lit(MAX_SLOTS))).cast("long")


def slot_of(position, n_candidates, total):
    """The slot a position in [0, total) lies in."""
    return F.call_function("div", position * slot_count(n_candidates), total)


def draw_table(ranges: DataFrame) -> DataFrame:
    """(ord, state_key, slot, next_token, count, lo, hi): candidates under the slots they cover.

    A draw then joins on (state, slot) and meets about ``PER_SLOT`` candidates, or the at most ``ONE_SLOT`` of
    a small state, instead of a large state's whole list, and a hub state's candidates and draws are both
    spread by slot. A state's rows grow by at most its number of slots, n / ``PER_SLOT``.
    """
    n, total = F.col("n_candidates"), F.col("total")
    covered = F.sequence(slot_of(F.col("lo"), n, total), slot_of(F.col("hi") - 1, n, total))
    return ranges.select("ord", "state_key", F.explode(covered).alias("slot"),
                         "next_token", "count", "lo", "hi")


def one_slot_draws(transitions: DataFrame, buckets: int) -> DataFrame:
    """The rows of :func:`draw_table` of states that all have a single slot, dealt to ``buckets`` by (ord, state_key, slot).

    One shuffle serves the sums and the buckets, since the slot is known before.
    """
    # The slot is 0, as no count is negative; a literal would be dropped from the window's keys and cost a second shuffle.
    slotted = transitions.withColumn("slot", F.when(F.col("count") < 0, 1).otherwise(0).cast("long"))
    dealt = slotted.repartition(buckets, "ord", "state_key", "slot").withColumn("bucket", hash_bucket(F.col("next_token")))
    # Sorted by state_key first, whose first bytes tell most rows apart; one order comes at a time.
    upto = F.sum("count").over(Window.partitionBy("state_key", "slot", "ord").orderBy("bucket", "next_token").rowsBetween(
        Window.unboundedPreceding, 0))
    return dealt.select("ord", "state_key", "slot", "next_token", "count", (upto - F.col("count")).alias("lo"), upto.alias("hi"))
