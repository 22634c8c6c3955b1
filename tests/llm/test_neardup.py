import random
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gramloom.llm import neardup, toxicity
from gramloom.llm.common import over_texts, texts_of


def brute(rows):
    """Components by comparing all pairs."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def changed(text, n, draw):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10 ** 6)}"
    return " ".join(words)


def found(spark, documents, folder, rows):
    return neardup.near_duplicates(documents(*rows).select("doc_id", "text"), folder).collect()


def test_groups_of_copies_equal_brute_force(spark, documents, folder, prose):
    draw, rows = random.Random(1), []
    for base in range(25):
        text = prose(base, draw.randint(6, 200))
        rows += [(len(rows) + k, changed(text, draw.choice([0, 0, 1, 2, 4]), draw)) for k in range(draw.choice([1, 2, 5]))]
    rows += [(1000 + k, t) for k, t in enumerate(["One two", "one TWO", "one two three", "ÀB c", "àb c", "x", "X"])]
    rows.append((900, prose(99, 3000)))
    want = brute(rows)
    for r in found(spark, documents, folder, rows):
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_a_large_group_of_near_copies_is_joined(spark, documents, folder, prose):
    draw, base = random.Random(2), prose(5, 180)
    rows = [(i, changed(base, draw.randint(1, 5), draw)) for i in range(250)]
    rows += [(300 + i, prose(50 + i, 60) + " " + base[:200]) for i in range(60)]  # share a passage, are no copies
    want = brute(rows)
    assert Counter(c for _, c in want.values()).most_common(1)[0][1] > 150
    assert {r["doc_id"]: r["component_id"] for r in found(spark, documents, folder, rows)} == {i: c for i, (_, c) in want.items()}


def test_links_inside_a_crowd_of_other_texts_are_found(spark, documents, folder, crowd):
    rows = crowd(400, 40)
    want = brute(rows)
    assert Counter(Counter(c for _, c in want.values()).values()) == {1: 360, 2: 40}
    assert {r["doc_id"]: r["component_id"] for r in found(spark, documents, folder, rows)} == {i: c for i, (_, c) in want.items()}


def test_texts_beside_a_large_group_meet_it_as_a_whole(spark, documents, folder, prose):
    draw, base = random.Random(4), prose(12, 150)
    rows = [(i, changed(base, draw.randint(1, 3), draw)) for i in range(300)]
    rows += [(1000 + i, base + " " + " ".join(f"o{i}x{k}" for k in range(draw.randint(44, 60)))) for i in range(60)]  # below the threshold
    rows += [(2000 + i, base + " " + " ".join(f"q{i}x{k}" for k in range(30))) for i in range(5)]  # linked with some copies
    want = brute(rows)
    assert {r["doc_id"]: r["component_id"] for r in found(spark, documents, folder, rows)} == {i: c for i, (_, c) in want.items()}
    compared = [spark.read.parquet(f"{folder}/{name}").count() for name in ("pairs1", "pairs2", "meetings")]
    assert sum(compared) < 8 * len(rows)  # 300 x 60 before


def test_awkward_rows(spark, documents, folder, awkward):
    got = found(spark, documents, folder, awkward)
    assert len(got) == len(awkward)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == r["doc_id"] and r["kept"]
    assert {r["doc_id"]: r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 1}


def test_rows_of_one_id_are_one_document(spark, documents, folder, prose):
    a, b = prose(1, 50), prose(2, 50)
    got = found(spark, documents, folder, [(5, a), (5, b), (7, a), (9, b)])
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 5), (7, 5), (9, 5)}


def test_empty_table(spark, documents, folder):
    assert found(spark, documents, folder, []) == []


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (4, 5)], [(9, k) for k in range(1, 9)], [(1, 1)], [], [(5, 6), (2, 1), (6, 2), (8, 7)]])
def test_components_of_paths_and_stars(spark, folder, edges):
    got = neardup.components(spark.createDataFrame(edges, "a long, b long"), folder).collect()
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["id"]: r["component"] for r in got} == {x: parent[x] for x in linked}


def test_links_that_are_stars_take_no_round(spark, folder):
    links = spark.createDataFrame([(1, 2), (3, 1), (9, 5)], "a long, b long")
    assert sorted(map(tuple, neardup.components(links, folder).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (9, 5)]
    assert sorted(p.name for p in Path(folder).iterdir()) == ["round0"]


def test_texts_go_to_python_in_small_batches(spark, documents):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    texts_of(documents((1, "a")))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"


def test_remembered_words_stay_small():
    hashes, scores = neardup._Words(), toxicity.Scores({})
    for k in range(100_000):
        hashes[b"w%d" % k], scores[f"w{k}"]
    assert max(len(hashes), len(scores)) <= 1 << 16 and hashes[b"w7"] == xxhash.xxh3_64_intdigest(b"w7")


def test_long_texts_go_to_python_in_smaller_batches(spark):
    texts_of(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    rows = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    count = over_texts(lambda: lambda texts: pa.array([len(texts)] * len(texts), pa.int32()), "int")
    assert rows.select(count("text").alias("n")).agg(F.max("n")).first()[0] < 200
