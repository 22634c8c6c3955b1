import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramloom.llm import html, language, mixing, quality, toxicity
from gramloom.llm.common import row_share

SF = "/root/testdata/sf0.01"


# ---- languages ---------------------------------------------------------------------

def longest_pieces(word, text):
    """Brute force: the longest piece from each place that occurs in the text."""
    n = at = 0
    while at < len(word):
        k = 1
        while at + k < len(word) + 1 and word[at:at + k] in text:
            k += 1
        at, n = at + max(1, k - 1), n + 1
    return n


def test_suffix_automaton_gives_longest_matches():
    draw = random.Random(5)
    for _ in range(150):
        text = "".join(draw.choice("abc ") for _ in range(draw.randint(1, 40)))
        word = "".join(draw.choice("abcd ") for _ in range(draw.randint(1, 15)))
        assert language.SuffixAutomaton(text).pieces(word) == longest_pieces(word, text)


def test_languages_of_awkward_rows(spark, documents, awkward):
    learnt = language.learn(spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "fr"), (4, "x", None)],
                                                  "doc_id long, text string, lang string"))
    assert set(learnt) == {"en", "de"}
    rows = documents(*awkward, (20, "the cat"), (21, "die katze und"), (22, "12 34"))
    got = {r["doc_id"]: r["f"] for r in rows.select("doc_id", language.identify(F.col("text"), learnt).alias("f")).collect()}
    assert [got[i]["lang"] for i in (1, 2, 3, 20, 21, 22)] == ["und", "und", "und", "en", "de", "und"]
    assert all(0 <= f["score"] <= 1 for f in got.values())
    assert documents((1, "word")).select(language.identify(F.col("text"), {}).alias("f")).first()["f"]["lang"] == "und"


@pytest.mark.parametrize("hot", [None, 5])
def test_languages_of_a_hot_or_null_id_are_sampled(spark, hot, monkeypatch):
    monkeypatch.setattr(language, "row_share", lambda i, t, share: F.lit(True) if hot else row_share(i, t, share))  # the hot id is chosen
    labelled = spark.range(3000).select(F.lit(hot).cast("long").alias("doc_id"), F.format_string("w%04d", "id").alias("text"), F.lit("en").alias("lang"))
    assert 60 <= len(language.learn(labelled)["en"].split()) <= 2 * language.LEARNT_DOCS


def test_language_of_held_out_documents(spark):
    from gramloom.llm.queries import op6_language
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op6_language(spark, SF).where("held_out").collect()
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) > 0.97 * len(rows)


# ---- toxicity ----------------------------------------------------------------------

def maximal_segments(scores):
    """Brute force by the recursive definition: the best segment, then those left and right of it."""
    def within(a, b):
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > 0 and (best is None or total > best[2] + 1e-9):
                    best = (i, j + 1, total)
        if best is None:
            return []
        return within(a, best[0]) + [best] + within(best[1], b)
    return within(0, len(scores))


def test_all_maximal_segments():
    draw = random.Random(8)
    for _ in range(200):
        scores = np.array([draw.choice([-5.1, -2.03, -1.007, 1.0, 3.01, 4.1]) + draw.random() / 1000 for _ in range(draw.randint(1, 14))])
        assert [s[:2] for s in toxicity.segments(scores)] == [s[:2] for s in maximal_segments(scores)]


def test_toxicity_of_held_out_documents(spark):
    from gramloom.llm.queries import op9_toxicity
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [(r["predicted"], labels[r["doc_id"]]) for r in op9_toxicity(spark, "/root/testdata/sf0.1").where("held_out").collect() if r["doc_id"] in labels]
    assert sum(p == y for p, y in rows) > 0.95 * len(rows)
    assert sum(p for p, y in rows if y) > 0.85 * sum(y for _, y in rows)


def test_toxicity_of_awkward_rows(spark, documents, awkward):
    texts = [(i, f"neutral words number {i} here") for i in range(40)] + [(100 + i, f"neutral wretch words {i} wretch") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in texts] + [(999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(documents(*texts), labels)
    got = {r["doc_id"]: r["f"] for r in documents(*awkward, (50, "a wretch there")).select("doc_id", toxicity.score(F.col("text"), model).alias("f")).collect()}
    assert got[50]["score"] >= 0.5 and all(got[i]["score"] < 0.5 for i in (1, 2, 3))
    empty = toxicity.learn(documents(), labels)
    assert documents((1, "wretch")).select(toxicity.score(F.col("text"), empty).alias("f")).first()["f"]["score"] == 0.0


# ---- quality -----------------------------------------------------------------------

def test_counts_equal_brute_force(prose):
    draw = random.Random(2)
    cases = ["", " ", "a\na\n\n \na", "x " * 40, "a b c d e f g h a b c d e f g h i", "# * $%&|<>!"]
    cases += [prose(i, draw.randint(1, 120), 12) + "\n" + prose(i, 9, 12) for i in range(40)]
    for text in cases:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        seen, dups = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dups += line in seen
                seen.add(line)
        assert quality.statistics(text)[0] == [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated)], text


def test_trees_are_monotone_and_flat_arrays_score_as_nodes():
    rng = np.random.default_rng(3)
    x = rng.random((800, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.3 * rng.random(800) > 0.8).astype(float)
    trees = quality.fit(x, y, [1, 0, -1], trees=30)
    grid = np.repeat(x[:50], 20, 0)
    for f, sign in ((0, 1), (2, -1)):
        moved = grid.copy()
        moved[:, f] = np.tile(np.linspace(0, 1, 20), 50)
        assert (np.diff(trees.margin(moved).reshape(50, 20), axis=1) * sign >= -1e-12).all()

    def walk(row):
        total = 0.0
        for t in range(len(trees.feature)):
            k = 0
            while k < trees.feature.shape[1]:
                k = 2 * k + 1 + int(row[trees.feature[t, k]] > trees.threshold[t, k])
            total += trees.leaf[t, k - trees.feature.shape[1]]
        return total

    assert np.allclose(trees.margin(x[:40]), [walk(r) for r in x[:40]])
    assert ((trees.margin(x) > 0) == y).mean() > 0.85


def test_quality_verdicts(spark, documents, awkward):
    from gramloom.llm.queries import op5_quality
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op5_quality(spark, SF).collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(r["kept"] == labels[r["doc_id"]] for r in rows) > 0.97 * len(rows)
    got = documents(*awkward).select("doc_id", quality.judge(F.col("text"), None).alias("f")).collect()
    assert len(got) == len(awkward) and all(r["f"]["base_failed"] and not r["f"]["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4))
    assert quality.learn(documents(), spark.createDataFrame([], "doc_id long, quality int")) is None


# ---- pages -------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- x -->
<div class="ad">Buy this now.</div><article><h1>A  title &amp; more</h1><p>First para\tgraph, with some <b>bo</b>ld words in it, and more.<br>Next.
<p>Second paragraph of the article, which goes on for a while.</p></article><div class="comments"><p>Nice one, thanks for that.</p></div><footer>&copy; someone</footer>"""


def test_blocks_decode_and_join_white_space():
    texts = [t for _, t, _ in html.blocks(PAGE)]
    assert texts == ["Home", "Buy this now.", "A title & more", "First para graph, with some bold words in it, and more. Next.",
                     "Second paragraph of the article, which goes on for a while.", "Nice one, thanks for that.", "© someone"]
    for page in (None, "", "<", "<p", "<!--", "<script>x", "</div></p>", "<p class='a", "&#x110000; &bogus;", "<" * 3000, "<div>x" * 5000):
        html.blocks(page)


def test_viterbi_equals_all_sequences():
    rng = np.random.default_rng(4)
    for n in range(1, 7):
        field = html.Field(rng.normal(size=html.N_FEATURES), rng.normal(size=(2, 2)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, html.N_FEATURES)) * 0.3
        gain = x @ field.weights

        def score(labels):
            return (sum(g for g, y in zip(gain, labels) if y) + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))
                    + field.ends[0, labels[0]] + field.ends[1, labels[-1]])

        best = max(([(k >> i) & 1 for i in range(n)] for k in range(2 ** n)), key=score)
        assert field.labels(x).astype(int).tolist() == best


def test_field_on_unseen_layouts_and_pages(spark):
    pages = spark.createDataFrame([(i, PAGE) for i in range(30)] + [(99, None), (98, "")], "page_id long, html string")
    field = html.learn(pages)
    fresh = html.laid_out(["another text with other words that were never seen before in training, at all."] * 3, 60)
    assert np.mean([(field.labels(x) == y).mean() for x, y in fresh]) > 0.95
    got = {r["page_id"]: r["t"] for r in pages.select("page_id", html.main_text(F.col("html"), field).alias("t")).collect()}
    assert got[99] == got[98] == ""
    assert got[0] == "A title & more First para graph, with some bold words in it, and more. Next. Second paragraph of the article, which goes on for a while."
    html.learn(pages.where("false"))


# ---- mixing ------------------------------------------------------------------------

@pytest.mark.parametrize("same", [None, 5])
def test_pages_of_a_hot_or_null_id_are_sampled(spark, same, monkeypatch):
    monkeypatch.setattr(html, "row_share", lambda i, t, share: F.lit(True) if same else row_share(i, t, share))
    pages = spark.range(9000).select(F.lit(same).cast("long").alias("page_id"), F.format_string("<p>%d</p>", "id").alias("html"))
    assert html.SAMPLE / 2 <= html.sample(pages, 9000).count() <= 2 * html.SAMPLE


def test_rates_meet_targets_as_a_solver_would(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    n = rng.integers(1, 500, 300)
    mixture = mixing.Mixture(["a", "b", "c"], np.zeros((3, 4)))
    mixture.probabilities = lambda x: x  # the statistics stand for the probabilities
    frame = spark.createDataFrame([(i, int(n[i]), [float(v) for v in p[i]]) for i in range(300)], "doc_id long, n_tokens long, x array<double>")
    mixing.fit(frame, mixture, {"a": 0.7, "b": 0.2, "c": 0.1})
    rate = np.array([r["r"] for r in frame.select("doc_id", mixture.rate(F.col("x")).alias("r")).orderBy("doc_id").collect()])
    assert (rate >= 0).all()
    assert np.allclose((rate * n) @ p / n.sum(), [0.7, 0.2, 0.1], atol=1e-5)


def test_copies_keep_expectations_and_columns(spark, documents, awkward):
    frame = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert abs(frame.select(F.avg(mixing.copies(F.lit(1.3), F.col("doc_id")))).first()[0] - 1.3) < 0.02
    stated = mixing.with_statistics(documents(*awkward), F.col("text"), "n_tokens", "x")
    assert {r["doc_id"]: r["n_tokens"] for r in stated.collect() if r["doc_id"] in (1, 2, 3, 7)} == {1: 0, 2: 0, 3: 0, 7: 16_000}
    plain = mixing.Mixture(["one"], np.zeros((0, 0)))
    assert mixing.mixed(documents(*awkward), plain).count() == len(awkward)
    two = mixing.Mixture(["a", "b"], np.zeros((2, 10)), [[-1.0, -1.0]])  # a rate of 2 for all
    twice = mixing.mixed(documents(*awkward), two)
    assert twice.count() == 2 * len(awkward) and twice.columns == documents().columns


def test_classifier_tells_domains_apart():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (200, 2)), rng.normal(4, 1, (50, 2))])
    y = np.array([0] * 200 + [1] * 50)
    weights = mixing.classifier(x, y, ["a", "b"])
    assert ((np.column_stack([x, np.ones(250)]) @ weights.T).argmax(1) == y).mean() > 0.97


def test_mixing_works_a_text_out_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixture = mixing.Mixture(["a", "b"], np.random.default_rng(7).normal(0, 1, (2, 10)), [[0.3, -0.5], [-0.4, 0.2], [0.1, -0.3]])
    made = mixing.mixed(docs, mixture)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 3  # words, lines twice
    stated = mixing.with_statistics(docs.select("doc_id", "text"), F.col("text"), "n", "x").collect()
    wanted = spark.createDataFrame([(r["doc_id"], r["x"]) for r in stated], "doc_id long, x array<double>").select(
        "doc_id", mixing.copies(mixture.rate(mixture.probabilities(F.col("x"))), F.col("doc_id")).alias("n")).where("n > 0")
    assert sorted(map(tuple, made.groupBy("doc_id").agg(F.count("*")).collect())) == sorted(map(tuple, wanted.collect()))


def test_statistics_mark_the_kinds_of_characters_in_one_pass(spark, documents, awkward):
    rows = [*awkward, (8, "A9#!?."), (9, "!!??.."), (10, "&|<>*$%# 12 ABé😀")]
    made = mixing.with_statistics(documents(*rows), F.col("text"), "n_tokens", "x")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    for r in made.collect():
        body = r["text"] or ""
        shares = [sum(c in kind for c in body) / max(1, len(body)) for kind in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", ".", "!?")]
        assert r["x"][3:8] == shares
