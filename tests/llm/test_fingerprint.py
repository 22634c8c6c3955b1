import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gramloom.llm import fingerprint


def paragraphs(text):
    return set(re.findall(r"[^\n]{1,24}\n*|\n+", text[:240])) | set(re.findall(r"[^\n]{1,120}\n*|\n+", text[240:]))


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    ids = sorted(rows, reverse=True)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, head = rows[i] or "", rows[following] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + head[:k]
        yield i, (len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(paragraphs(text), paragraphs(edited)), alike(paragraphs(text), paragraphs(head)))


def test_likeness_equals_sets_of_paragraphs(spark, documents, prose):
    rows = {i: prose(i % 5, 3 * i) + "\n" + prose(i, 40) for i in range(0, 90, 3)} | {200: None, 201: "", 202: "é😀x", 203: "a" * 20_000, 204: prose(1, 4000)}
    got = {r["doc_id"]: r for r in fingerprint.compare_with_edits(documents(*rows.items()).select("doc_id", "text")).collect()}
    for i, (n, sha, edited, following) in expected(rows):
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (n, sha)
        assert got[i]["near_edited"] == pytest.approx(edited) and got[i]["near_next"] == pytest.approx(following)


def test_peeling_recovers_differences_and_larger_tables_are_tried(spark):
    rows = [(n, list(range(100, 100 + n)), list(range(103, 110))) for n in (0, 1, 5, 40)]
    frame = spark.createDataFrame(rows, "n int, a array<long>, b array<long>").select(
        "n", *[F.transform(c, lambda v: fingerprint._checked(F.xxhash64(v).bitwiseAND(F.lit((1 << 48) - 1)))).alias(c) for c in "ab"])
    got = frame.select("n", "a", "b", fingerprint.differing(F.col("a"), F.col("b")).alias("d"),
                       fingerprint.peeled(fingerprint.sketch(F.col("a"), 12), fingerprint.sketch(F.col("b"), 12), 12).alias("small")).collect()
    for r in got:
        assert {(c["n"], c["key"]) for c in r["d"]} == {(1, k) for k in set(r["a"]) - set(r["b"])} | {(-1, k) for k in set(r["b"]) - set(r["a"])}
    assert {r["n"]: r["small"] is None for r in got}[40]  # thirty-odd differences do not fit twelve cells


def test_equal_texts_have_equal_fingerprints_and_repeats_stay(spark, documents, awkward):
    got = fingerprint.compare_with_edits(documents(*awkward, (50, "same text here"), (51, "same text here")).select("doc_id", "text")).collect()
    assert len(got) == len(awkward) + 2
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[50] == prints[51] and prints[1] == prints[2] and prints[50] != prints[1]
    assert fingerprint.compare_with_edits(documents().select("doc_id", "text")).count() == 0
    one = fingerprint.compare_with_edits(documents((3, "alone in the table")).select("doc_id", "text")).first()
    assert one["near_next"] == 1.0
