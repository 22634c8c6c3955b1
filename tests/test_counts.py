from collections import Counter

import pytest
from pyspark.sql import functions as F

from gramloom.operators.candidates import cumulative_ranges, draw_table, hub_states, slot_of, state_totals
from gramloom.operators.lookup import lookup
from gramloom.operators.ngrams import count_transitions, ngrams, ngrams_added, window_ngrams
from gramloom.operators.ranking import dense_ids, frequency_rank, running_total
from gramloom.operators.sentences import doc_tokens, sentences
from gramloom.operators.tally import tally

TEXT = "The cat eats fish. The cat sleeps! " + "a b a c a b " * 40 + ". Hi."


def brute(tokens, k):
    return Counter((" ".join(tokens[i:i + k]), tokens[i + k]) for i in range(len(tokens) - k))


def as_counter(frame):
    return Counter({(r.state_key, r.next_token): r["count"] for r in frame.collect()})


def test_two_token_states(corpus):
    grams = count_transitions(ngrams(sentences(corpus("the cat eats fish"), "source_id"), range(2, 3)))
    assert as_counter(grams) == Counter({
        ("<s> the", "cat"): 1, ("the cat", "eats"): 1, ("cat eats", "fish"): 1, ("eats fish", "</s>"): 1})


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 10_000])
def test_chunks_do_not_change_ngrams(corpus, chunk):
    sents = sentences(corpus(TEXT), "source_id")
    arrays = [r.toks for r in sents.select("toks").collect()]
    got = ngrams(sents, range(1, 5), chunk=chunk).groupBy("ord", "state_key", "next_token").count().collect()
    for k in range(1, 5):
        expected = sum((brute(a, k) for a in arrays), Counter())
        assert Counter({(r.state_key, r.next_token): r["count"] for r in got if r.ord == k}) == expected


@pytest.mark.parametrize("k", [1, 2, 3])
def test_window_form_agrees(corpus, k):
    sents = sentences(corpus(TEXT, "One word. Two words here"), "source_id").withColumn(
        "source_id", F.md5(F.array_join("toks", " ")))
    arrays = count_transitions(ngrams(sents, range(k, k + 1)))
    windows = count_transitions(window_ngrams(doc_tokens(sents, "source_id"), k, "source_id", "sent_no"))
    assert as_counter(arrays) == as_counter(windows)


def test_short_sentence_lengths(corpus):
    rows = ngrams_added(sentences(corpus("Hi."), "source_id"), range(1, 5), "source_id").orderBy("ord").collect()
    assert [r.ngrams_added for r in rows] == [2, 1, 0, 0]


@pytest.mark.parametrize("chunk", [3, 64])
def test_tally_counts_everything_in_one_pass(corpus, chunk):
    data = corpus(("x", TEXT), ("x", "Again the cat."), ("y", "12 !"), ("z", None))
    rows = tally(data, 2, chunk).collect()
    sents = [r.toks for r in sentences(data, "source_id").select("toks").collect()]
    by_order = lambda o: {(r.state_key, r.next_token): r.n for r in rows if r.ord == o}
    assert by_order(1) == dict(sum((brute(s, 1) for s in sents), Counter()))
    assert by_order(2) == dict(sum((brute(s, 2) for s in sents), Counter()))
    assert {t: n for (_, t), n in by_order(0).items()} == dict(Counter(t for s in sents for t in s))
    assert {s: n for (s, _), n in by_order(-1).items()} == {"x": sum(map(len, sents)), "y": 0, "z": 0}
    assert by_order(-2)[("x", "")] == sum(len(s) - 1 for s in sents)
    assert by_order(-3)[("x", "")] == sum(max(0, len(s) - 2) for s in sents)


def test_dense_ids_and_running_total(spark):
    rows = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("token"), (F.col("id") % 7).alias("v"))
    ids = dense_ids(rows, "token", "n", 10)
    assert sorted(r.n for r in ids.collect()) == list(range(11, 5011))
    again = dense_ids(rows.repartition(13), "token", "n", 10)
    assert ids.exceptAll(again).isEmpty()
    summed = running_total(ids.withColumn("n", F.col("n") - 10), "n", "v", "s", per_bucket=100).orderBy("n").collect()
    total = 0
    for r in summed:
        total += r.v
        assert r.s == total


def test_frequency_rank_has_gaps(spark):
    rows = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 1)], "t string, f0 long")
    assert {r.t: r.r for r in frequency_rank(rows, "f0", "r").collect()} == {"a": 1, "b": 2, "c": 2, "d": 4}


def hub_model(spark):
    hub = spark.range(400).select(F.lit("hub").alias("state_key"), F.concat(F.lit("w"), "id").alias("next_token"),
                                  F.when(F.col("id") == 3, 5000).otherwise(F.col("id") % 3 + 1).cast("long").alias("count"))
    few = spark.createDataFrame([("s", "a", 3), ("s", "b", 1)], "state_key string, next_token string, count long")
    return hub.unionByName(few).select(F.lit(1).cast("tinyint").alias("ord"), "*")


def test_hub_ranges_equal_plain_ranges_and_tile(spark):
    model = hub_model(spark)
    plain = cumulative_ranges(model)
    hubs = cumulative_ranges(model, hub_states(state_totals(model), 50))
    assert plain.count() == 402
    assert plain.select(*sorted(plain.columns)).exceptAll(hubs.select(*sorted(hubs.columns))).isEmpty()
    rows = sorted((r.lo, r.hi, r.total) for r in plain.where("state_key = 'hub'").collect())
    assert rows[0][0] == 0 and rows[-1][1] == rows[0][2]
    assert all(a[1] == b[0] for a, b in zip(rows, rows[1:]))


def test_every_draw_meets_exactly_one_candidate(spark):
    model = hub_model(spark)
    totals = state_totals(model)
    draws = totals.select("*", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("draw")).withColumn(
        "slot", slot_of(F.col("draw"), F.col("n_candidates"), F.col("total")))
    table = draw_table(cumulative_ranges(model))
    hit = lookup(draws, table, ["ord", "state_key", "slot"], ["draw"]).where("lo <= draw AND draw < hi")
    assert hit.count() == draws.count()
    drawn = hit.groupBy("ord", "state_key", "next_token").agg(F.count(F.lit(1)).alias("count"))
    assert drawn.exceptAll(model).isEmpty() and drawn.count() == model.count()
    assert table.count() <= 402 + 400 / 16 + 2


def test_lookup_with_one_key_in_most_rows(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("k"))
    table = spark.createDataFrame([(1, "x"), (1, "y"), (2950, "z")], "k long, v string")
    assert lookup(rows, table, ["k"], ["id"]).count() == 2 * 2900 + 1
    left = lookup(rows, table, ["k"], ["id"], how="left")
    assert left.count() == 2 * 2900 + 100 and left.where("v IS NULL").count() == 99


def test_join_to_a_small_side_salted_beyond_the_bound(spark, monkeypatch):
    from gramloom.operators import ranking
    rows = spark.createDataFrame([(f"t{i}", 1 if i % 3 else i) for i in range(300)], "token string, freq long")
    small = rows.select(F.col("freq").alias("f")).distinct().withColumn("r", F.col("f") * 10)
    sent = sorted(tuple(r) for r in ranking.joined_to_small(rows, small, F.col("freq"), "f").collect())
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 0)
    salted = sorted(tuple(r) for r in ranking.joined_to_small(rows, small, F.col("freq"), "f").collect())
    assert sent == salted and len(sent) == 300


def test_successor_lists_in_bounded_parts(spark, tmp_path):
    from gramloom.operators.successors import successor_lists
    hot = [(1, "the", f"w{i:03d}", i % 4 + 1) for i in range(250)]  # one state with many successors, over several tasks
    cold = [(2, "a b", "c", 3), (2, "a b", "d", 1), (1, "x", "y", 2)]
    rows = spark.createDataFrame(hot + cold, "ord int, state_key string, next_token string, count long").repartition(7)
    got = successor_lists(rows, str(tmp_path / "s"), chunk=40).collect()
    assert max(r.entries for r in got) <= 40 and all(len(r.successors.split(" ")) == r.entries for r in got)
    the = sorted((r for r in got if r.state_key == "the"), key=lambda r: r.part)
    assert [r.part for r in the] == list(range(7)) and " ".join(r.successors for r in the) == " ".join(f"{t}:{c}" for _, _, t, c in hot)
    assert {(r.state_key, r.successors) for r in got if r.state_key != "the"} == {("a b", "c:3 d:1"), ("x", "y:2")}


def test_heavy_split_join_with_a_planted_hot_key(spark):
    from gramloom.operators.ranking import joined_with_heavy_split
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        rows = spark.createDataFrame([(i, "</s>" if i % 2 else f"t{i % 50}") for i in range(2000)] + [(9999, None)], "s long, tok string")
        other = spark.createDataFrame([("</s>", 0)] + [(f"t{i}", i + 1) for i in range(50)] + [(None, -1)], "tok string, id long")
        got = joined_with_heavy_split(rows, other, "tok")
        assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in rows.join(other, "tok").collect())
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
