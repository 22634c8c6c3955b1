import hashlib
import random
import re

from pyspark.sql import functions as F

from gramloom.llm import pii, secrets
from gramloom.llm.spans import listed

PIECES = ["token=", "SECRET : '", "api_key\"=\"", "abcdef0123456789ab", "AKIA", "ABCDEFGHIJ1234567", "secret: ", "x", " ", "é", "😀", "\n", "=", ".", "-", "1", "255",
          "300", "10.0.0.1", "4111111111111111", "4111 1111 1111 1111", "+1 (555) 123-4567", "+", "a@b.c", "@", "_d@e.f", "0", "mail ", "(", ")", "deadbeefdeadbeef"]


def texts():
    draw = random.Random(6)
    return [(i, "".join(draw.choice(PIECES) for _ in range(draw.randint(1, 25)))) for i in range(600)]


def base_secrets(text):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
        r"(?ia)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_personal(text):
    out = [(0, m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end(), "card"))
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_fixed_formats_of_secrets_equal_brute_force(spark, documents, folder):
    rows = dict(texts())
    for r in secrets.find(documents(*rows.items()), folder).collect():
        base = [s for s in r["spans"] if s["kind"] != "random"]
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in base] == base_secrets(rows[r["doc_id"]])


def test_random_tokens_are_found_and_language_is_left(spark, documents, folder):
    draw = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = {i: f"key is {''.join(draw.choice(alphabet) for _ in range(44))} here" for i in range(20)}
    rows |= {100 + i: f"see /documents/reports2/january-summary-of-the-northern-regions-{'and-more' * (i % 4)} now" for i in range(20)}
    rows |= {200: "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1Z", 201: "abcdefghijklmnopqrstuvwxyz0123456789"}
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find(documents(*rows.items()), folder).collect()}
    assert sum(got[i] == ["random"] for i in range(20)) >= 17
    assert sum(bool(got[i]) for i in rows if i >= 100) <= 1


def test_redaction_covers_overlapping_spans(spark):
    row = spark.sql("select 'ab token=abcdefabcdef0123 end' text, array(named_struct('start', 3, 'rank', 0, 'end', 25, 'kind', 'assign'), named_struct('start', 9, 'rank', 2, 'end', 25, 'kind', 'hex')) spans")
    assert row.select(secrets.redacted(F.col("text"), F.col("spans")).alias("t")).first()["t"] == "ab [ASSIGN] end"


def test_base_personal_data_equals_brute_force(spark, documents, folder):
    rows = dict(texts())
    for r in pii.find(documents(*rows.items()), folder).collect():
        assert [(s["rank"], s["start"], s["end"], s["kind"]) for s in r["base"]] == base_personal(rows[r["doc_id"]])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


def test_trees_as_an_expression_equal_the_arrays(spark):
    import numpy as np

    from gramloom.llm.quality import fit
    x = np.random.default_rng(1).normal(size=(300, 3))
    trees = fit(x, (x[:, 0] + x[:, 1] > 0).astype(float), [0, 0, 0], trees=10, depth=3, rate=0.3)
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "i int, x array<double>")
    got = {r["i"]: r["m"] for r in frame.select("i", pii.scored(trees, F.col("x")).alias("m")).collect()}
    assert np.allclose([got[i] for i in range(len(x))], trees.margin(x))


def test_awkward_rows_and_empty_tables(spark, documents, awkward, tmp_path):
    for module, base in ((secrets, base_secrets), (pii, base_personal)):
        rows = awkward + [(8, "1" * 20_000), (9, "1 " * 20_000), (10, "a" * 20_000 + "@b"), (11, "1.2.3.4" * 3000), (12, "a@b" + ".c" * 20_000)]
        got = module.find(documents(*rows), str(tmp_path / f"{module.__name__}1")).collect()
        assert len(got) == len(rows)
        assert all(not r["spans"] for r in got if r["doc_id"] in (1, 2, 3))
        assert module.find(documents(), str(tmp_path / f"{module.__name__}2")).collect() == []


def test_query_digests(spark):
    from gramloom.llm.queries import op7_secrets, op8_pii
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op7_secrets(spark, sf).collect():
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_secrets(rows[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["n_hex"] == want.count("hex:")
    for r in op8_pii(spark, sf).collect():
        want = ",".join(f"{k}:{a}:{b}" for _, a, b, k in base_personal(rows[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["n_card"] == want.count("card:")


def test_personal_models_and_thresholds_come_from_all_candidates(spark):
    """Equal candidates are counted, and trees of counted rows are those of the rows repeated."""
    import numpy as np
    from gramloom.llm.quality import fit
    rng = np.random.default_rng(3)
    x, n = rng.integers(0, 9, (60, 4)).astype(float), rng.integers(1, 9, 60)
    y = (x[:, 0] + rng.integers(0, 4, 60) > 6).astype(float)
    counted = fit(x, y, [0] * 4, trees=4, depth=3, counts=n.astype(float))
    repeated = fit(np.repeat(x, n, 0), np.repeat(y, n), [0] * 4, trees=4, depth=3)
    assert np.array_equal(counted.feature, repeated.feature) and np.allclose(counted.threshold, repeated.threshold)
    assert np.allclose(counted.leaf, repeated.leaf)

    rows = spark.range(30_000).selectExpr(
        "id doc_id", "array(named_struct('start', 0, 'rank', 3, 'end', 9, 'kind', 'phone', 'x', transform(sequence(0, 15), "
        "i -> if(i = 4, double(id % 2), 0.0D)), 'base', id % 2 = 1)) candidates")
    trees, thresholds = pii.learn(rows)
    assert set(thresholds) == {"phone"}
    seen = {}
    real, pii.fit = pii.fit, lambda *a, **named: seen.update(named) or real(*a, **named)
    try:
        pii.learn(rows)
    finally:
        pii.fit = real
    whole = rows.where("pmod(xxhash64(doc_id, candidates[0].start, candidates[0].kind), 3) != 2").count()
    assert seen["counts"].sum() == whole  # two thirds of all 30,000, which a sample of 20,000 would not give
