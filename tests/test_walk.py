from collections import Counter

import pytest
from pyspark.sql import functions as F

from gramloom.operators.candidates import state_totals
from gramloom.operators.ngrams import count_transitions, ngrams
from gramloom.operators.sentences import sentences
from gramloom.plans.index import DrawIndex
from gramloom.plans.scoring import forced_steps
from gramloom.plans.model import TransitionModel
from gramloom.plans.stats import backoff, perplexity, stats
from gramloom.plans.walk import chains, generation_runs, run_texts, walk
from gramloom.sources.sinks import write_chains, write_run_texts

TEXT = "The cat eats fish. The cat sleeps here. A dog eats the cat. A bird sings the song."
PROMPTS = [(1, "", 3, 6), (2, "The cat", 2, 4), (3, None, 9, 9), (4, "zzz", 2, 5), (5, "a dog eats the", 3, 1)]


@pytest.fixture(scope="module")
def transitions(spark):
    frame = spark.createDataFrame([("s", TEXT)], "source_id string, content string")
    return count_transitions(ngrams(sentences(frame, "source_id"), range(1, 4)))


@pytest.fixture(scope="module")
def index(spark, transitions, tmp_path_factory):
    return DrawIndex.build(transitions, str(tmp_path_factory.mktemp("index")), buckets=4)


def prompts(spark):
    return spark.createDataFrame(PROMPTS, "run_id long, seed string, requested_order int, max_tokens int")


def test_walks_follow_the_model(spark, transitions, index, tmp_path):
    walks = walk(index, prompts(spark), 5, str(tmp_path / "w"))
    counts = {(r.ord, r.state_key, r.next_token): r["count"] for r in transitions.collect()}
    totals, fans = Counter(), Counter()
    for (o, s, _), n in counts.items():
        totals[o, s] += n
        fans[o, s] += 1
    steps = walks.steps.orderBy("run_id", "step").collect()
    history = {1: ["<s>"], 2: ["the", "cat"], 3: ["<s>"], 4: ["zzz"], 5: ["a", "dog", "eats", "the"]}
    order = {p[0]: p[2] for p in PROMPTS}
    for r in steps:
        hist = history[r.run_id]
        known = [o for o in range(1, min(order[r.run_id], len(hist)) + 1) if (o, " ".join(hist[-o:])) in totals]
        assert r.order_used == max(known)
        state = (r.order_used, " ".join(hist[-r.order_used:]))
        assert r.state_key == state[1] and r.n_candidates == fans[state]
        assert r.chosen_prob == counts[(*state, r.next_token)] / totals[state]
        hist.append(r.next_token)
        if r.next_token == "</s>":
            hist.append("<s>")
    made = Counter(r.run_id for r in steps)
    assert made[1] == 6 and made[2] == 4 and made[3] == 9 and made[4] == 0 and made[5] == 1
    texts = {r.run_id: r for r in run_texts(walks).collect()}
    assert texts[4].stop_reason == "dead end" and texts[4].text == "zzz" and texts[4].tokens == 0
    assert texts[1].stop_reason == "token limit"
    assert texts[2].text.startswith("the cat")
    report = backoff(walks.steps).collect()
    assert report[-1].order_used is None and report[-1].steps == len(steps) and report[-1].pct == 100.0
    assert perplexity(walks.steps).count() == 4
    write_run_texts(run_texts(walks), str(tmp_path / "texts"), long_run=5)
    stored = {r.run_id: r.long_run for r in spark.read.parquet(str(tmp_path / "texts")).collect()}
    assert set(stored) == set(texts) and {i for i, mark in stored.items() if mark} <= {1, 3}


def test_same_seed_same_walks(spark, index, tmp_path):
    few = prompts(spark).where("run_id IN (1, 2)")
    first = walk(index, few, 7, str(tmp_path / "a")).steps
    second = walk(index, few.repartition(3), 7, str(tmp_path / "b")).steps
    other = walk(index, few, 8, str(tmp_path / "c")).steps
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    assert not first.exceptAll(other).isEmpty()


def test_run_defaults(spark):
    asked = spark.createDataFrame([(1, None, 2, 0), (2, "x", 3, None), (3, "x " * 100, 3, 2**20 - 64)],
                                  "run_id long, seed string, requested_order int, max_tokens int")
    made = generation_runs(asked).orderBy("run_id").collect()
    assert [(r.seed, r.max_tokens) for r in made] == [("", 50), ("x", 50), ("x " * 100, 2**20 - 64)]
    assert [len(r.history) for r in made] == [1, 1, 100]
    too_long = spark.createDataFrame([(1, "x", 3, 2**30)], "run_id long, seed string, requested_order int, max_tokens int")
    with pytest.raises(Exception, match="at most"):
        generation_runs(too_long).collect()


def test_prompts_out_of_bounds_are_refused(spark, index, tmp_path):
    for order in (0, -1, 10, None):
        bad = spark.createDataFrame([(1, "x", order, 3)], "run_id long, seed string, requested_order int, max_tokens int")
        with pytest.raises(ValueError, match="order"):
            walk(index, bad, 1, str(tmp_path / f"o{order}"))
    with pytest.raises(ValueError, match="unique"):
        walk(index, prompts(spark).union(prompts(spark)), 1, str(tmp_path / "twice"))


def test_walks_are_recorded_with_ids_that_go_on(spark, index, tmp_path):
    model = TransitionModel(spark, str(tmp_path / "m"))
    assert model.generation_runs().count() == model.generation_steps().count() == 0
    walks = walk(index, prompts(spark), 5, str(tmp_path / "w"))
    model.record(walks.runs, walks.steps)
    model.record(walks.runs, walks.steps)
    assert sorted(r.id for r in model.generation_runs().collect()) == list(range(1, 11))
    assert len({r.created_at for r in model.generation_runs().collect()}) == 2
    assert stats(model, "backoff").collect()[-1].steps == 2 * walks.steps.count()


def test_sentence_start_backs_off(spark, index, tmp_path):
    steps = walk(index, prompts(spark).where("run_id = 3"), 1, str(tmp_path / "w")).steps.orderBy("step").collect()
    after_end = [b for a, b in zip(steps, steps[1:]) if a.next_token == "</s>"]
    assert after_end and all(r.order_used == 1 and r.state_key == "<s>" for r in after_end)


def test_reopened_index_and_lookup_plan(spark, index):
    def steps_of(which, name):
        made = walk(which, prompts(spark), 5, f"{index.path}-{name}").steps
        return {r["run_id"]: r["n"] for r in made.groupBy("run_id").agg(F.count("*").alias("n")).collect()}

    before = steps_of(index, "a")
    for name in ("states", "draws"):
        spark.sql(f"DROP TABLE {index._table(name)}")
    with pytest.raises(ValueError, match="version"):
        DrawIndex.open(spark, index.path, "another")
    again = DrawIndex.open(spark, index.path, "")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert steps_of(again, "b") == before and again.buckets == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    needed = spark.range(10).select((F.col("id") % 2).cast("tinyint").alias("ord"), F.col("id").cast("string").alias("state_key"))
    plan = needed.hint("merge").join(again.states().hint("merge"), ["ord", "state_key"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1  # only the small side moves


def test_chains(spark, tmp_path):
    words = spark.createDataFrame([(["a", "b", "a", "c", "d"],)], "toks array<string>")
    index = DrawIndex.build(count_transitions(ngrams(words, range(1, 2))), str(tmp_path / "i"), buckets=2)
    made = chains(index, spark.range(300).withColumnRenamed("id", "run_id"), 1, 4, 3, str(tmp_path / "c"))
    follows = {"a": {"b", "c"}, "b": {"a"}, "c": {"d"}, "d": set()}
    starts = Counter()
    for r in made.collect():
        starts[r.chain[0]] += 1
        assert all(y in follows[x] for x, y in zip(r.chain, r.chain[1:]))
        assert len(r.chain) == 4 or r.chain[-1] == "d"
    assert set(starts) == {"a", "b", "c"} and min(starts.values()) > 70  # states, not occurrences
    write_chains(made, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 300


def test_forced_steps_by_hand(spark, transitions, corpus):
    text = "The cat sings. " + "the cat " * 100
    sents = sentences(corpus(("h", text)), "source_id")
    log = forced_steps(sents, transitions, state_totals(transitions), 3, ["source_id"]).collect()
    counts = {(r.ord, r.state_key, r.next_token): r["count"] for r in transitions.collect()}
    totals = Counter()
    for (o, s, _), n in counts.items():
        totals[o, s] += n
    expected = {}
    for r in sents.collect():
        for p in range(1, len(r.toks)):
            fired = [o for o in range(1, min(3, p) + 1) if (o, " ".join(r.toks[p - o:p])) in totals]
            o = max(fired, default=None)
            state = " ".join(r.toks[p - o:p]) if o else None
            seen = counts.get((o, state, r.toks[p]))
            expected[r.sent_no, p + 1] = (o, state, r.toks[p], seen / totals[o, state] if seen else None)
    assert {(r.sent_no, r.pos): (r.order_used, r.state_key, r.next_token, r.chosen_prob) for r in log} == expected
    assert len(log) == len(expected)
