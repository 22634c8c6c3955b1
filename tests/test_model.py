import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gramloom import AlreadyTrained, TransitionModel, load_corpus
from gramloom.plans.checks import integrity
from gramloom.plans.stats import stats
from gramloom.sources.corpus import spread
from gramloom.streaming.ingest import refused_texts, stream_corpus, train_from_stream

A = ("a", "The cat eats fish. The cat sleeps. The dog eats fish.")
B = ("b", "A bird eats. The cat eats fish!")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture()
def model(spark, tmp_path):
    return TransitionModel(spark, str(tmp_path / "model"))


def test_two_trainings_equal_one(spark, corpus, tmp_path, model):
    model.train(corpus(A), 3)
    model.train(corpus(B), 3)
    both = TransitionModel(spark, str(tmp_path / "both"))
    both.train(corpus(A, B), 3)
    assert rows(model.transitions()) == rows(both.transitions())
    assert rows(model.vocabulary().select("token", "freq")) == rows(both.vocabulary().select("token", "freq"))
    assert rows(model.documents().select("id", "name", "token_count")) == [(1, "a", 17), (2, "b", 11)]
    added = model.training_runs().groupBy("ord").agg(F.sum("ngrams_added"))
    assert rows(added) == rows(model.transitions().groupBy("ord").agg(F.sum("count")))
    assert [r.id for r in model.training_runs().orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]
    reopened = TransitionModel(spark, model.path)
    assert rows(reopened.transitions()) == rows(both.transitions())
    assert {r.violations for r in integrity(model).collect()} == {0}
    ids = {r.token: r.id for r in model.vocabulary().collect()}
    by_id = {(r.ord, r.state_key, r.next_id): r["count"] for r in model.transitions_with_ids().collect()}
    assert by_id == {(r.ord, r.state_key, ids[r.next_token]): r["count"] for r in model.transitions().collect()}


def test_token_ids_never_change(corpus, model):
    model.train(corpus(A), 1)
    before = {r.token: r.id for r in model.vocabulary().collect()}
    model.train(corpus(B), 1)
    after = {r.token: r.id for r in model.vocabulary().collect()}
    assert before.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1))


def test_guard_and_force(corpus, model):
    model.train(corpus(A), 2)
    with pytest.raises(AlreadyTrained):
        model.train(corpus(A), 3)
    once = rows(model.transitions())
    report = model.train(corpus(A, B), 2)
    assert rows(report.refused) == [("a",)]
    model.train(corpus(A), 2, force=True)
    merged = {r[:3]: r[3] for r in rows(model.transitions())}
    assert all(merged[r[:3]] >= 2 * r[3] for r in once)
    assert [r.name for r in model.documents().orderBy("id").collect()] == ["a", "b", "a"]


def test_invalid_input(spark, corpus, model, tmp_path):
    for k in (0, 10):
        with pytest.raises(ValueError):
            model.train(corpus(A), k)
    with pytest.raises(ValueError):
        model.train(corpus(A).limit(0), 2)
    with pytest.raises(ValueError):
        model.prune(1)
    with pytest.raises(AnalysisException):
        load_corpus(spark, str(tmp_path / "absent.txt"))
    with pytest.raises(ValueError, match="unknown report"):
        stats(model, "nonsense")
    assert model.commits() == []


def test_failed_training_stays_invisible_and_can_be_retried(corpus, model, monkeypatch):
    model.train(corpus(A), 2)
    before = rows(model.transitions())
    with monkeypatch.context() as broken:
        broken.setattr(TransitionModel, "_write_runs", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            model.train(corpus(B), 2)
    assert rows(model.transitions()) == before and model.documents().count() == 1
    model.train(corpus(B), 2)
    assert model.documents().count() == 2


def test_prune_rebuild_compact(corpus, model):
    model.train(corpus(A), 2)
    model.train(corpus(B), 2)
    full, words = rows(model.transitions()), rows(model.vocabulary())
    report = model.prune(2)
    kept = rows(model.transitions())
    assert {r.ord: r.transitions for r in report.collect()} == {o: sum(1 for r in kept if r[0] == o) for o in (1, 2)}
    assert kept == [r for r in full if r[3] >= 2]
    model.prune(2)
    assert rows(model.transitions()) == kept
    assert rows(model.vocabulary()) == words and model.documents().count() == 2
    model.rebuild()
    assert rows(model.transitions()) == full
    model.compact()
    assert rows(model.transitions()) == full and rows(model.vocabulary()) == words
    model.train(corpus(("c", "The cat eats.")), 2)
    assert dict((r[:3], r[3]) for r in rows(model.transitions()))[(1, "the", "cat")] == 4


def test_reports(corpus, model):
    model.train(corpus(A), 2)
    model.train(corpus(B), 1)
    assert [tuple(r) for r in stats(model, "growth").select("run", "name", "ord", "cumulative_ngrams").collect()] == [
        (1, "a", 1, 14), (2, "a", 2, 25), (3, "b", 1, 34)]
    assert [r.trained_on for r in stats(model, "size").collect()] == ["a, b", "a"]
    top = [tuple(r) for r in stats(model, "zipf").take(3)]
    assert top == [("eats", 4, 1), ("the", 4, 1), ("cat", 3, 3)]  # a tie, then a gap
    entropy = {(r.ord, r.state_key): r.entropy_bits for r in stats(model, "entropy").collect()}
    assert entropy[(1, "cat")] == 0.918  # 2 of 3 and 1 of 3


def test_readers_agree(spark, corpus, tmp_path):
    text = 'One "two", three.\nFour five! Six; it’s... seven'
    (tmp_path / "t.txt").write_text(text, encoding="utf-8")
    frame = spark.createDataFrame([(text, "x")], "text string, other string")
    frame.write.parquet(str(tmp_path / "t.PARQUET"))
    frame.write.csv(str(tmp_path / "t.csv"), header=True, escape='"')
    seen = []
    for name in ("t.txt", "t.PARQUET", "t.csv"):
        model = TransitionModel(spark, str(tmp_path / f"m-{name}"))
        model.train(load_corpus(spark, str(tmp_path / name)), 3)
        seen.append(rows(model.transitions()))
        assert [r.name for r in model.documents().collect()] == [str(tmp_path / name)]
    assert seen[0] == seen[1] == seen[2] and seen[0]
    whole = load_corpus(spark, str(tmp_path / "t.txt"), whole_text=True).collect()
    assert [r.content for r in whole] == [text]
    several = load_corpus(spark, [str(tmp_path / "t.txt"), str(tmp_path / "t.csv")])
    assert several.select("source_id").distinct().count() == 2


def test_stream_equals_batch_and_replay_adds_nothing(spark, corpus, tmp_path, model):
    for i, text in enumerate([A[1], B[1], "More words. And more."]):
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(offsets):
        stream = stream_corpus(spark, str(tmp_path / "in"), "text string", files_per_batch=1)
        train_from_stream(stream, model, 2, str(tmp_path / offsets)).awaitTermination()

    run("offsets")
    batch = TransitionModel(spark, str(tmp_path / "batch"))
    batch.train(spark.read.parquet(str(tmp_path / "in")).select(F.lit("x").alias("source_id"), F.col("text").alias("content")), 2)
    assert rows(model.transitions()) == rows(batch.transitions())
    assert len(model.commits()) == 3
    run("offsets")
    assert len(model.commits()) == 3 and refused_texts(model).count() == 0
    run("offsets-lost")   # all batches are offered again
    assert rows(model.transitions()) == rows(batch.transitions()) and len(model.commits()) == 3
    assert refused_texts(model).count() == 3


def test_a_new_checkpoint_with_new_files_is_trained(spark, tmp_path, model):
    for folder, text in (("one", A[1]), ("two", "Wholly other words here.")):
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.parquet(str(tmp_path / folder))
        stream = stream_corpus(spark, str(tmp_path / folder))
        train_from_stream(stream, model, 1, str(tmp_path / f"offsets-{folder}")).awaitTermination()
    assert "wholly" in {r.token for r in model.vocabulary().collect()} and len(model.commits()) == 2


def test_a_deleted_checkpoint_and_new_files_are_trained(spark, tmp_path, model):
    """The query id lives in the checkpoint: with the checkpoint gone, batch 0 of other files is a new batch."""
    import shutil
    offsets = tmp_path / "offsets"
    for folder, text in (("one", A[1]), ("two", "Wholly other words here.")):
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.parquet(str(tmp_path / folder))
        train_from_stream(stream_corpus(spark, str(tmp_path / folder)), model, 1, str(offsets)).awaitTermination()
        shutil.rmtree(offsets)
    assert "wholly" in {r.token for r in model.vocabulary().collect()} and len(model.commits()) == 2
    assert refused_texts(model).count() == 0


def test_empty_files_and_batches_without_tokens_do_not_stop_a_stream(spark, tmp_path, model):
    folder = str(tmp_path / "in")
    spark.createDataFrame([], "text string").coalesce(1).write.parquet(folder)
    spark.createDataFrame([("",), (None,)], "text string").coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([("Real words at last.",)], "text string").coalesce(1).write.mode("append").parquet(folder)
    query = train_from_stream(stream_corpus(spark, folder, files_per_batch=1), model, 1, str(tmp_path / "o"))
    query.awaitTermination()
    assert query.exception() is None
    assert {"real", "words", "at", "last"} <= {r.token for r in model.vocabulary().collect()} and len(model.commits()) == 2  # the empty file commits nothing


def test_text_and_csv_streams_and_a_source_in_several_batches(spark, tmp_path, model):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("One two. Three four", encoding="utf-8")
    train_from_stream(stream_corpus(spark, str(tmp_path / "t"), glob="*.txt", kind="text"), model, 1, str(tmp_path / "o1")).awaitTermination()
    spark.createDataFrame([('five, "six"',)], "text string").write.csv(str(tmp_path / "c"), header=True, escape='"')
    train_from_stream(stream_corpus(spark, str(tmp_path / "c"), glob="*.csv", kind="csv"), model, 1, str(tmp_path / "o2")).awaitTermination()
    assert {"one", "four", "five", "six"} <= {r.token for r in model.vocabulary().collect()}
    for text in ("Seven.", "Eight."):
        spark.createDataFrame([("s", text)], "source_id string, content string").coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema("source_id string, content string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "p"))
    train_from_stream(stream, model, 1, str(tmp_path / "o3")).awaitTermination()
    assert {"seven", "eight"} <= {r.token for r in model.vocabulary().collect()}


def test_integrity_finds_planted_faults(corpus, model):
    model.train(corpus(A), 2)

    class Broken:
        def __init__(self, **tables):
            self.tables = tables

        def __getattr__(self, name):
            return (lambda: self.tables[name]) if name in self.tables else getattr(model, name)

    def faults(**tables):
        return {r["check"] for r in integrity(Broken(**tables)).collect() if r.violations}

    words, docs, runs, moves = model.vocabulary(), model.documents(), model.training_runs(), model.transitions()
    assert faults() == set()
    assert faults(vocabulary=words.union(words.limit(1))) == {"vocabulary.id unique", "vocabulary.token unique"}
    assert faults(vocabulary=words.where("token != 'cat'")) == {"transitions.next_token known"}
    assert faults(vocabulary=words.withColumn("freq", F.lit(None).cast("long"))) == {"vocabulary not null"}
    assert faults(documents=docs.limit(0)) == {"training_runs.document_id known"}
    assert faults(documents=docs.withColumn("name", F.lit(None).cast("string"))) == {"documents not null"}
    assert faults(training_runs=runs.union(runs)) == {"training_runs.id unique"}
    assert faults(transitions=moves.union(moves.limit(1))) == {"transitions key unique"}
    assert faults(transitions=moves.withColumn("count", F.lit(None).cast("long"))) == {"transitions not null"}


def test_one_row_group_is_spread(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    filled = spread(frame).select(F.spark_partition_id().alias("p")).distinct().count()
    assert filled >= spark.sparkContext.defaultParallelism


def test_reports_are_in_order(corpus, model):
    model.train(corpus(A, B), 2)
    sizes = [r.ord for r in stats(model, "size").collect()]
    assert sizes == sorted(sizes)
    entropies = [(-r.entropy_bits, r.ord, r.state_key) for r in stats(model, "entropy").collect()]
    assert entropies == sorted(entropies)


def test_vacuum_after_many_batches_keeps_every_answer(spark, corpus, model, tmp_path):
    from pathlib import Path
    texts = [f"Word{i % 7} and word{i % 5} went on. The end{i % 3} came." for i in range(50)]
    for i, text in enumerate(texts):
        model.train(corpus((f"s{i}", text)), 2)
    full, words = rows(model.transitions()), rows(model.vocabulary())
    model.prune(2)
    pruned = rows(model.transitions())
    model.compact()
    done = model.vacuum()
    assert done["folders"] >= 50 and done["commit_files"] == 53  # 50 trainings, prune, compact, history
    counts = [p for p in Path(model.path, "counts").iterdir() if p.name.startswith("batch=")]
    vocabulary = [p for p in Path(model.path, "vocabulary").iterdir() if p.name.startswith("batch=")]
    commit_files = list(Path(model.path, "commits").glob("*.parquet"))
    assert len(counts) == 2 and len(vocabulary) == 1 and len(commit_files) == 1  # the compacted counts, the history
    assert rows(model.transitions()) == pruned and rows(model.vocabulary()) == words
    assert model.documents().count() == 50 and [c.commit_id for c in model.commits()] == list(range(1, 54))
    model.rebuild()
    assert rows(model.transitions()) == full
    model.train(corpus(("s50", "Fresh words here.")), 2)
    assert "fresh" in {r.token for r in model.vocabulary().collect()}
    assert model.vacuum()["folders"] >= 1 and rows(model.transitions()) != full


def test_compacted_counts_are_clustered_by_state(spark, corpus, model):
    model.train(corpus(A), 2)
    model.train(corpus(B), 2)
    model.compact()
    files = spark.read.parquet(f"{model.path}/counts/batch={model.commits()[-1].batch}").select(
        F.input_file_name().alias("f"), "ord", "state_key").groupBy("f", "ord").agg(F.min("state_key").alias("lo"), F.max("state_key").alias("hi")).collect()
    for order in {r.ord for r in files}:
        spans = sorted((r.lo, r.hi) for r in files if r.ord == order)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # each file its own range of states


def test_sketches_estimate_size_across_batches_and_snapshots(spark, corpus, model):
    words = [f"w{i}" for i in range(400)]
    for b in range(3):
        model.train(corpus((f"s{b}", ". ".join(" ".join(words[(b * 37 + j * 11) % 400:(b * 37 + j * 11) % 400 + 5]) for j in range(120)))), 2)

    def near(approx, exact):
        got = {r.ord: (r.transitions, r.states) for r in approx.collect()}
        want = {r.ord: (r.transitions, r.states) for r in exact.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[o][i] - want[o][i]) <= 0.05 * want[o][i] for o in want for i in (0, 1))

    summary = lambda: stats(model, "size")
    near(model.approximate_size(), summary())
    model.prune(2)
    near(model.approximate_size(), summary())
