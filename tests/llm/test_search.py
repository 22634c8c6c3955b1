import math
import random
import re
from collections import Counter

from gramloom.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    if text is None:
        return []
    return TERM.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, top=10):
    """Every document scored for every item by the definition, then sorted."""
    terms = [words(t) for _, t in docs]
    big_n = sum(1 for t in terms if t)
    big_l = sum(len(t) for t in terms)
    df = Counter(w for t in terms for w in set(t))
    out = []
    for item, text in items:
        q = words(text)
        scored = []
        for (doc_id, _), t in zip(docs, terms):
            if not t:
                continue
            tf, m = Counter(t), 25 + (75 * len(t) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                        for w in q if tf[w])
            if score > 0:
                scored.append((score, doc_id))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] if s[1] is not None else 0))
        out += [(item, r + 1, d, s) for r, (s, d) in enumerate(scored[:top])]
    return out


def run(spark, docs, items, top=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", search.F.lit(1.5))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", search.F.lit("x"))
    return [tuple(r) for r in search.search(d, b, spark, top).orderBy("item_id", "rank").collect()]


def test_equals_brute_force_with_ties_repeats_and_awkward_rows(spark, prose, awkward):
    draw = random.Random(5)
    docs = [(i, prose(i, draw.randint(0, 60), vocabulary=60)) for i in range(120)]
    docs += [(200, docs[3][1]), (200, docs[3][1]), (201, docs[7][1]), (None, docs[9][1].upper())]
    docs += [(i + 300 if i is not None else None, t) for i, t in awkward]
    items = [(k, prose(1000 + k, draw.randint(0, 12), vocabulary=60)) for k in range(8)] + [(50, None), (51, ""), (52, "zzzz qqq")]
    items += [(53, docs[3][1][:80]), (54, "É漢字 x\x00y ABC")]
    assert run(spark, docs, items) == brute(docs, items)


def test_rare_terms_first_and_small_k(spark, prose):
    docs = [(i, prose(i, 40, vocabulary=30) + (" unusual" if i % 17 == 0 else "")) for i in range(80)]
    items = [(1, "unusual " + prose(5, 10, vocabulary=30)), (2, "unusual unusual")]
    assert run(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == []
    assert run(spark, [(1, None), (2, "")], [(1, "a")]) == []
