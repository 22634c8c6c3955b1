"""Secrets in texts: fixed formats, and a battery of randomness tests over unknown tokens. DataFrame expressions alone.

Fixed formats are assignments, access keys and long hexadecimal runs. Every other run of token characters that mixes
digits with letters is tested. From its characters an encoding is inferred (hexadecimal, base 32, 36, 62 or 64), which
numbers the characters. Three tests look for departures from a random string: chi-squared over the alphabet, runs of
low and high characters (Wald and Wolfowitz), and serial correlation of neighbours. A token that no test rejects, after
Bonferroni's correction, looks random. Language can look so by chance, the more often the shorter it is: the count of equal
pairs of characters gives each token the probability of being language, and within each class of length the
Benjamini-Hochberg rule bounds the share of false discoveries over all tokens of the corpus. The rule needs only a
histogram of probabilities, of fixed size.

Null and empty texts have no spans. Tokens overlapping a fixed format are left to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.spans import matches, overlapping

KINDS = ["assign", "access", "hex", "random"]  # the order of spans that begin alike
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
LENGTHS = [28, 40, 64]  # bounds of the classes of length, from 20 up
FALSE_DISCOVERIES = 0.01
REJECTED = 0.01  # probability below which the battery calls a token not random
#: Probability that two characters of language are equal (coincidence index of European languages); of numbers, a tenth.
SAME_IN_LANGUAGE, SAME_IN_NUMBERS = 0.067, 0.1
BINS = 400  # of the histogram, ten per power of ten
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters in numeric order.
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER, "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}


def key_of(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: equal only for equal id and text."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def fixed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, spans, tokens): spans of fixed formats by start, and other tokens that mix digits with letters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", key_of(F.col("doc_id"), F.col("text")).alias("key"), matches(F.col("text"), ASSIGN).alias("assign"),
                       matches(F.col("text"), "AKIA[A-Z0-9]{14,}", F.col("text").contains("AKIA")).alias("access"),
                       matches(F.col("text"), "[0-9a-f]{16,}").alias("hex"), matches(F.col("text"), TOKEN).alias("tokens"))
    valued = F.filter("assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12)

    def of(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("rank"), s["end"], F.lit(kind).alias("kind")))

    spans = F.array_sort(F.concat(of("assign", valued), of("access", F.col("access")), of("hex", F.col("hex"))))
    rows = rows.select("doc_id", "key", spans.alias("spans"), "tokens")
    return rows.select("doc_id", "key", "spans", F.filter("tokens", lambda t: t["match"].rlike("[0-9]") & t["match"].rlike("[A-Za-z]") &
                                                   ~overlapping(F.col("spans"), t)).alias("tokens"))


def _normal(z: Column) -> Column:
    """The normal distribution function, by a logistic curve good to 2e-4."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def battery(tokens: DataFrame) -> DataFrame:
    """Rows with a column ``match``, with encoding, p_random (the least of three tests, corrected) and p_language."""
    encoding = F
    for name in ("hex", "HEX", "base32", "base36", "BASE36", "base62", "base64"):
        encoding = encoding.when(F.col("match").rlike(f"^[{ALPHABETS[name]}]+$"), name)
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), F.col("encoding"))
    rows = tokens.withColumn("encoding", encoding.otherwise("base64url")).withColumn("alphabet", alphabet)
    # a run of base64url may hold + and / as well: those stand beyond the alphabet and are taken off
    rows = rows.withColumn("string", F.expr("regexp_replace(match, concat('[^', replace(alphabet, '-', ''), '-]'), '')"))
    rows = rows.withColumn("n", F.length("string").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
    squares = F.aggregate(F.transform(F.split("alphabet", ""), lambda c: F.col("n") - F.length(F.replace(F.col("string"), c, F.lit("")))),
                          F.lit(0.0), lambda done, x: done + F.when(x > F.col("n"), 0.0).otherwise(x * x))
    codes = F.expr("transform(filter(split(string, ''), c -> c != ''), c -> cast(instr(alphabet, c) - 1 as double))")
    high = F.expr("translate(string, alphabet, concat(repeat('0', cast(k / 2 as int)), repeat('1', cast(k - floor(k / 2) as int))))")
    rows = rows.withColumn("squares", squares).withColumn("codes", codes).withColumn("bits", high)

    # chi-squared, to a normal deviate by Wilson and Hilferty
    n, k = F.col("n"), F.col("k")
    chi = k * F.col("squares") / n - n
    spread = 2 / (9 * (k - 1))
    z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / (k - 1)) - (1 - spread)) / F.sqrt(spread)
    # runs of low and high characters
    ones = F.length(F.replace(F.col("bits"), F.lit("0"), F.lit(""))).cast("double")
    pairs = 2 * ones * (n - ones)
    runs = F.length(F.regexp_replace("bits", "0+|1+", "x"))
    z_runs = F.try_divide(runs - (pairs / n + 1), F.sqrt(F.try_divide(pairs * (pairs - n), n * n * (n - 1))))
    # correlation of neighbours
    mean = F.aggregate("codes", F.lit(0.0), lambda done, x: done + x) / n
    rows = rows.withColumn("mean", mean)
    variance = F.aggregate("codes", F.lit(0.0), lambda done, x: done + (x - F.col("mean")) * (x - F.col("mean")))
    products = F.aggregate(F.zip_with("codes", F.slice("codes", 2, F.size("codes")), lambda x, y: (x - F.col("mean")) * (y - F.col("mean"))),
                           F.lit(0.0), lambda done, x: done + F.coalesce(x, F.lit(0.0)))
    z_serial = F.try_divide(products, variance) * F.sqrt(n)

    def two_sided(z: Column) -> Column:
        return F.coalesce(2 * _normal(-F.abs(z)), F.lit(0.0))  # no variation at all: certainly not random

    least = F.least(1 - _normal(z_chi), two_sided(z_runs), two_sided(z_serial))
    same = F.when(F.lower("encoding") == "hex", SAME_IN_NUMBERS).otherwise(SAME_IN_LANGUAGE)
    couples = n * (n - 1) / 2
    z_language = ((F.col("squares") - n) / 2 - couples * same) / F.sqrt(couples * same * (1 - same))
    return rows.select(*tokens.columns, "encoding", F.least(3 * least, F.lit(1.0)).alias("p_random"), _normal(z_language).alias("p_language"))


def thresholds(found: DataFrame) -> dict[int, float]:
    """For each class of length the largest p_language that Benjamini and Hochberg's rule accepts, from a histogram."""
    bins = found.groupBy("length_class", "bin").agg(F.count("*").alias("n")).collect()  # at most 4 x 401 rows
    out: dict[int, float] = {}
    for length in {r["length_class"] for r in bins}:
        mine = sorted(((r["bin"], r["n"]) for r in bins if r["length_class"] == length), reverse=True)
        total, seen, accepted = sum(n for _, n in mine), 0, -1.0
        for b, n in mine:
            seen += n
            if 10 ** (-b / 10) <= FALSE_DISCOVERIES * seen / total:
                accepted = 10 ** (-b / 10)
        out[length] = accepted
    return out


def find(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, key, spans) for every row of docs: spans of (start, rank, end, kind) in order.

    The fixed formats and tokens of all rows are written to ``folder``, a new folder that all executors share, so
    that texts are searched once.
    """
    spark = docs.sparkSession
    fixed(docs).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    tokens = rows.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("token")).select("row", "token.*")
    length_class = sum(((F.length("match") >= bound).cast("int") for bound in LENGTHS), F.lit(0))
    bin_of = F.least(F.floor(-10 * F.log10("p_language")), F.lit(BINS)).cast("int")
    found = battery(tokens).withColumn("length_class", length_class).withColumn("bin", bin_of)
    accepted = F.lit(False)
    for length, p in sorted(thresholds(found).items()):
        accepted |= (F.col("length_class") == length) & (F.pow(F.lit(10.0), -F.col("bin") / 10) <= p)
    added = (found.where(accepted & (F.col("p_random") >= REJECTED))
             .groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("rank"), "end", F.lit("random").alias("kind"))).alias("added")))
    joined = rows.drop("tokens").join(added, "row", "left")
    return joined.select("doc_id", "key", F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "added"))).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (start, rank, end, kind; by start) replaced by its kind in brackets; spans may overlap."""

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.when(s["end"] <= done["at"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["text"], between, mark).alias("text"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    return F.aggregate(spans, start, step, lambda done: F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text))))
