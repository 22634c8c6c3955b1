import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gramloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*(enc(row[k]) for k in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(nodes):
    """Levels of nodes up to one, and for each position its path of (sibling or None, slot)."""
    paths = [[] for _ in nodes]
    where = list(range(len(nodes)))
    while len(nodes) > 1:
        nxt = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        for leaf_at, at in enumerate(where):
            sib = at ^ 1
            paths[leaf_at].append((nodes[sib] if sib < len(nodes) else None, at % 2))
            where[leaf_at] = at // 2
        nodes = nxt
    return nodes[0], paths


def brute(rows, tamper):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, inner = {}, {}
    for g in langs:
        members = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs[g], paths = tree([leaf(r) for r in members])
        inner[g] = list(zip(members, paths))
    root, upper = tree([subs[g] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for r, path in inner[g]:
            full = path + upper[k]
            acc = leaf(tamper(r))
            for sib, slot in full:
                acc = h(acc) if sib is None else (h(acc, sib) if slot == 0 else h(sib, acc))
            out.append((r["doc_id"], leaf(r), subs[g], root, h(*(s for s, _ in full if s is not None)), acc, acc == root))
    return sorted(out, key=str)


def rows_of(spec):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), s)) for s in spec]


def run(spark, rows, alter=None):
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x") for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, root string")
    fields = {f: F.col(f) for f in merkle.FIELDS}
    if alter:
        fields["n_chars"] = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle.manifest(frame, merkle.leaf(fields), spark).collect()
    return sorted((tuple(r) for r in got), key=str)


def tampered(r):
    if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
        return dict(r, n_chars=r["n_chars"] + 1)
    return r


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (5, 8, 2), (13, 1, 4, 7)])
def test_equals_brute_force(spark, sizes):
    spec, k = [], 0
    for g, n in enumerate(sizes):
        lang = [None, "en", "zh", "é", "de"][g]
        for _ in range(n):
            spec.append((k * 3 % 11, f"text {k} é😀", lang, None if k % 4 == 0 else "s", None if k % 5 == 0 else k * 10))
            k += 1
    rows = rows_of(spec)
    assert run(spark, rows, alter=True) == brute(rows, tampered)
    assert all(r[-1] for r in run(spark, rows))


def test_awkward_rows(spark, awkward):
    spec = [(i, t, "en" if i is None or i % 2 else "fr", "s", None if t is None else len(t)) for i, t in awkward]
    spec += [(4, "same", "en", "s", 4), (None, None, None, None, None), (700, "", "en", "", 0)]
    rows = rows_of(spec)
    assert run(spark, rows, alter=True) == brute(rows, tampered)


def test_empty_table(spark):
    assert run(spark, []) == []
