"""What the stored steps leave on disk, and how much they shuffle."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from gramloom import queries
from gramloom.operators.candidates import one_slot_draws
from gramloom.operators.tally import GRAMS, longest, shorter
from gramloom.plans.index import DrawIndex
from gramloom.plans.model import TransitionModel
from gramloom.session import fresh_dir, open_files, small_reads, stored, tidy
from gramloom.sources.corpus import spread

CORPUS = [("x", "The word again the word. The other word, again.")] * 20


def test_longest_grams_are_one_row_a_position(spark):
    rows = longest(spark.createDataFrame([("x", "a b c d. e")], "source_id string, content string"), 2).collect()
    whole = {(r.state_key, r.next_token) for r in rows if r.ord == 2}
    assert whole == {("<s> a", "b"), ("a b", "c"), ("b c", "d"), ("c d", "</s>"), ("<s> e", "</s>")}
    assert {r.state_key for r in rows if r.ord == GRAMS} == {"d </s>", "</s>", "e </s>", " 6 x", " 3 x"}


def test_training_leaves_no_rows_of_its_first_step(spark):
    path = fresh_dir(spark, "scale")
    TransitionModel(spark, path).train(spark.createDataFrame(CORPUS, "source_id string, content string"), 2)
    folders = {p.name for p in Path(path.removeprefix("file:")).glob("counts/batch=*/ord=*")}
    assert folders == {"ord=-3", "ord=-2", "ord=-1", "ord=0", "ord=1", "ord=2"}


def test_draws_of_small_states_take_one_shuffle(spark):
    rows = spark.range(1000).select(F.lit(1).cast("tinyint").alias("ord"), (F.col("id") % 90).cast("string").alias("state_key"),
                                    F.col("id").cast("string").alias("next_token"), F.lit(2).cast("long").alias("count"))
    draws = one_slot_draws(stored(rows, "rows"), 8)
    plan = draws._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert draws.agg(F.max("hi")).first()[0] == 24


def test_an_index_of_small_and_large_states_tiles_every_state(spark):
    rows = spark.range(3000).select(
        F.lit(1).cast("tinyint").alias("ord"), F.when(F.col("id") < 2000, "hub").otherwise((F.col("id") % 300).cast("string")).alias("state_key"),
        F.col("id").cast("string").alias("next_token"), F.lit(1).cast("long").alias("count"))
    index = DrawIndex.build(rows, fresh_dir(spark, "index"), buckets=4)
    spans = index.draws().select("state_key", "lo", "hi").distinct().groupBy("state_key").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("covered"), F.max("hi").alias("end"))
    assert spans.join(index.states(), "state_key").where("covered != total or end != total").isEmpty()
    assert spans.count() == 301
    assert index.draws().where("state_key = 'hub'").select("slot").distinct().count() == 125


def test_counts_are_stored_in_order_and_share_beginnings(spark):
    path = fresh_dir(spark, "ordered")
    TransitionModel(spark, path).train(spark.createDataFrame(CORPUS, "source_id string, content string"), 2)
    files = list(Path(path.removeprefix("file:")).glob("counts/batch=*/ord=2/*.parquet"))
    for f in files:
        keys = [(r["state_key"], r["next_token"]) for r in pq.read_table(str(f), partitioning=None).to_pylist()]
        assert keys == sorted(keys)
        column = next(c for c in map(pq.ParquetFile(str(f)).metadata.row_group(0).column, range(2)) if c.path_in_schema == "state_key")
        assert "DELTA_BYTE_ARRAY" in column.encodings
    assert files


def test_an_index_is_written_one_order_at_a_time(spark, monkeypatch):
    rows = spark.createDataFrame([(o, f"s{i % 7}", f"t{i}", 1) for o in (1, 2, 3) for i in range(50)],
                                 "ord tinyint, state_key string, next_token string, count long")
    seen, write = [], DrawIndex._write
    def spy(self, name, rows, *args, **kwargs):
        if name == "draws":
            seen.append(sorted(r["ord"] for r in rows.select("ord").distinct().collect()))
        write(self, name, rows, *args, **kwargs)
    monkeypatch.setattr(DrawIndex, "_write", spy)
    index = DrawIndex.build(rows, fresh_dir(spark, "orders"), buckets=4)
    assert seen == [[1], [2], [3]] and index.draws().count() == 150


def test_spread_bounds_the_bytes_of_a_task(spark):
    path = fresh_dir(spark, "bytes")
    spark.range(200_000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("text")).repartition(16).write.parquet(path)
    frame = spark.read.parquet(path)
    assert spread(frame, task_bytes=100_000).rdd.getNumPartitions() > 50
    assert spread(frame, task_bytes=100_000).count() == 200_000


def test_tidy_restores_the_setting_and_stored_rows_stay(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with tidy(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
    assert stored(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count(), "kept").count() == 2
    small_reads(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)


def test_shorter_orders_are_summed_one_from_the_other(spark):
    rows = stored(longest(spark.createDataFrame(CORPUS, "source_id string, content string"), 3), "longest")
    kept = {}
    def keep(of_order, order):
        kept[order] = stored(of_order, "order")
        return kept[order]
    found = shorter(rows, 3, keep)
    assert list(kept) == [2, 1, 0]  # each stored before the one below is summed from it
    assert found.exceptAll(shorter(rows, 3)).isEmpty() and shorter(rows, 3).exceptAll(found).isEmpty()
    assert {(r.state_key, r.next_token): r.n for r in kept[1].where("state_key = 'the'").collect()} == {("the", "word"): 40, ("the", "other"): 20}


def test_counts_are_written_without_a_sort_by_order(spark):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with open_files(spark):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 16
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_chains_count_their_letters_once(spark, monkeypatch):
    """The index reads the counts several times, so they are stored: none of its reads goes back to the texts."""
    plans, build = [], DrawIndex.build
    monkeypatch.setattr(queries.DrawIndex, "build", lambda counts, path: (
        plans.append(counts._jdf.queryExecution().optimizedPlan().toString()), build(counts, path))[1])
    assert queries.chains_random_start(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").count()
    assert len(plans) == 1 and "Aggregate" not in plans[0] and "Relation" in plans[0]


def test_windows_get_whole_sentences_shuffled(spark):
    """A sentence moves as one row; its tokens become rows where their window is."""
    plan = queries.ngrams_window(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(doc_id") == 1
    assert plan.index("posexplode(toks") < plan.index("hashpartitioning(doc_id")


def test_forced_steps_leave_the_model_where_it_is(spark, monkeypatch):
    """Tokens come to the draws of small states; only the transitions of large states are shuffled."""
    from gramloom.plans import scoring
    rows = stored(spark.range(3000).select(
        F.lit(1).cast("tinyint").alias("ord"), F.when(F.col("id") < 2000, "hub").otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("state_key"),
        F.concat(F.lit("t"), "id").alias("next_token"), (F.col("id") + 1).alias("count")), "rows")
    index = DrawIndex.build(rows, fresh_dir(spark, "index"), buckets=4)
    toks = [["hub", "t5"], ["hub", "t1999", "x"], ["hub", "t2500"], ["s200", "t2000"], ["s200", "t2300"], ["s200", "t5"], ["zz", "t1"]]
    sents = spark.createDataFrame(list(enumerate(toks)), "sent_no long, toks array<string>").withColumn("d", F.lit(1))
    plans, lookup = [], scoring.lookup

    def spy(steps, table, *args, **kwargs):
        found = lookup(steps, table, *args, **kwargs)
        plans.append((table.count(), found._jdf.queryExecution().executedPlan().toString()))
        return found
    monkeypatch.setattr(scoring, "lookup", spy)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scoring.forced_steps(sents, rows, index.states(), 1, ["d"], index.draws()).drop("d").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    hub, s200 = 2000 * 2001 // 2, 2001 + 2301 + 2601 + 2901
    assert {(r.sent_no, r.pos): (r.state_key, r.next_token, r.chosen_prob, r.n_candidates) for r in got} == {
        (0, 2): ("hub", "t5", 6 / hub, 2000), (1, 2): ("hub", "t1999", 2000 / hub, 2000), (1, 3): (None, "x", None, None),
        (2, 2): ("hub", "t2500", None, 2000), (3, 2): ("s200", "t2000", 2001 / s200, 4), (4, 2): ("s200", "t2300", 2301 / s200, 4),
        (5, 2): ("s200", "t5", None, 4), (6, 2): (None, "t1", None, None)}
    draws, large = plans
    moved = [line for line in draws[1].split("\n") if "Exchange hashpartitioning" in line]
    assert "ShuffledHashJoin" in draws[1] and all("slot" in line for line in moved)
    joined = draws[1].split("ShuffledHashJoin")[1].split("FileScan parquet spark_catalog")[0]
    assert "Exchange" not in joined  # nothing between the join and the draws
    assert large[0] == 2000  # the hub's transitions, not all 3,000


def test_totals_are_written_one_order_at_a_time_and_unsorted_by_bucket(spark, monkeypatch):
    """The disk holds the shuffle of one order's totals, and no task sorts its rows by bucket."""
    rows = stored(spark.createDataFrame([(o, f"s{i % 7}", f"t{i}", 1) for o in (1, 2, 3) for i in range(50)],
                                        "ord tinyint, state_key string, next_token string, count long"), "rows")
    seen, write = [], DrawIndex._write

    def spy(self, name, rows, *args, **kwargs):
        seen.append((name, sorted(r["ord"] for r in rows.select("ord").distinct().collect())))
        write(self, name, rows, *args, **kwargs)
    monkeypatch.setattr(DrawIndex, "_write", spy)
    index = DrawIndex.build(rows, fresh_dir(spark, "orders"), buckets=4)
    assert [orders for name, orders in seen if name == "states"] == [[1], [2], [3]]
    assert index.states().count() == 21 and index.states().agg(F.sum("total")).first()[0] == 150
    for table in ("states", "draws"):
        files = sorted(Path(index.path.removeprefix("file:")).glob(f"{table}/*.parquet"))
        assert files and all([r["state_key"] for r in t] == sorted(r["state_key"] for r in t)
                             for t in (pq.read_table(str(f), partitioning=None).to_pylist() for f in files))


def test_a_walk_takes_its_prompts_words_once(spark, monkeypatch):
    from gramloom.plans import walk as walks
    starts = []
    monkeypatch.setattr(walks, "_advance", lambda index, start, *rest: starts.append(start) or start)
    prompts = spark.createDataFrame([(1, "the word", 2, 3)], "run_id long, seed string, requested_order int, max_tokens int")
    walks.walk(type("Index", (), {"spark": spark}), prompts, 1)
    plan = starts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "regexp_extract_all" not in plan
    assert starts[0].first()["tail"] == ["the", "word"]


def test_repeated_keys_are_found_by_hashes(spark, monkeypatch):
    """The check of the transitions' keys shuffles a hash a row, and the keys only of rows whose hash repeats (F8)."""
    from gramloom.plans import checks
    rows = spark.createDataFrame([(1, "a", "b"), (1, "a", "b"), (1, "a", "b"), (2, "a", "b"), (1, "a", None), (1, "a", None), (1, "c", "d")],
                                 "ord tinyint, state_key string, next_token string")
    plans, keep = [], checks.stored
    monkeypatch.setattr(checks, "stored", lambda found, label: (plans.append(found._jdf.queryExecution().executedPlan().toString()), keep(found, label))[1])
    found = checks._duplicates_of_many("key", rows, "ord", "state_key", "next_token").collect()
    assert [(r.check, r.violations) for r in found] == [("key", 2)]
    assert "hashpartitioning(_hash" in plans[0] and plans[0].count("Exchange") == 1
    assert checks._duplicates_of_many("key", rows.limit(1), "ord", "state_key", "next_token").first().violations == 0


def test_a_snapshot_shuffles_its_rows_once(spark, monkeypatch):
    """Rows are summed where the ranges of state_key have brought them, not by a shuffle of their own."""
    from gramloom.plans import model as models
    made = TransitionModel(spark, fresh_dir(spark, "snapshots"))
    for source in ("x", "y", "z"):
        made.train(spark.createDataFrame([(source, text) for _, text in CORPUS], "source_id string, content string"), 2)
    before = {(r.ord, r.state_key, r.next_token): r["count"] for r in made.transitions().collect()}
    plans, summed = [], models._summed
    monkeypatch.setattr(models, "_summed", lambda rows, n: (plans.append(summed(rows, n)), plans[-1])[1])
    made.prune(61)
    assert {(r.ord, r.state_key, r.next_token): r["count"] for r in made.transitions().collect()} == {k: n for k, n in before.items() if n >= 61}
    made.rebuild()
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(state_key" in plan and plan.count("Exchange") == 1
    assert {(r.ord, r.state_key, r.next_token): r["count"] for r in made.transitions().collect()} == before


def test_sums_windows_and_joins_by_state_move_nothing(spark, tmp_path):
    """Transitions dealt by state once, an order at a time, serve totals, distributions, ranges and lists."""
    from gramloom.operators.candidates import cumulative_ranges, next_distribution, state_totals
    from gramloom.operators.successors import _listed
    from gramloom.plans.index import by_state
    rows = stored(spark.range(900).select((F.col("id") % 3 + 1).cast("tinyint").alias("ord"), F.concat(F.lit("s"), F.col("id") % 40).alias("state_key"),
                                          F.concat(F.lit("t"), "id").alias("next_token"), (F.col("id") + 1).alias("count")), "rows")
    dealt = by_state(rows, str(tmp_path / "dealt"))
    state = ["ord", "state_key"]
    for made in (state_totals, lambda t: next_distribution(t, state_totals(t).hint("shuffle_hash")), cumulative_ranges, lambda t: _listed(t, state)):
        there = made(dealt)
        assert "Exchange" not in there._jdf.queryExecution().executedPlan().toString()
        assert there.exceptAll(made(rows)).isEmpty() and there.count() == made(rows).count()


def test_transitions_are_counted_one_order_after_the_other(spark, monkeypatch):
    """The disk holds the shuffle of one order at a time."""
    kept, keep = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda rows, label: (kept.append(keep(rows, label)), kept[-1])[1])
    found = queries.transitions_o1_o3(spark, "/root/testdata/sf0.001")
    assert [[r["ord"] for r in rows.select("ord").distinct().collect()] for rows in kept if "ord" in rows.columns] == [[3], [2], [1]]
    assert found.count() == sum(rows.count() for rows in kept if "ord" in rows.columns) > 0


def test_windows_get_sentences_as_texts(spark):
    """What the shuffle before the windows holds is a text a sentence, not an array."""
    plan = queries.ngrams_window(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = plan.index("hashpartitioning(doc_id")
    assert "split(sent" in plan[:dealt] and "array_join(" in plan[dealt:]
