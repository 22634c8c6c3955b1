"""Document fingerprints: invertible Bloom lookup tables of paragraph digests. DataFrame expressions alone.

A text is cut into paragraphs (lines; long ones every 120 characters, the first 240 characters every 24, so that short texts
have several). A digest holds 48 bits of the paragraph's hash and 16 bits that check them. A table has cells of a count and
the exclusive or of the digests put there; every digest is put into three. Tables of two versions are
subtracted cell by cell: what both share cancels out. Peeling takes a cell that holds one digest (count
of one, check bits right), takes the digest off its other cells, and so on until all is empty: the
digests taken are the paragraphs that differ. If cells remain, the table was too small, and a larger one is tried.

Long texts have their digests dealt by hash over parts of about four, each with tables of its own, so that work stays linear in the
text. The printed fingerprint is one table of all parts together. Likeness is the shared part of both
sets of digests, (a + b - d) / (a + b + d) for a and b digests of which d differ; two empty texts are alike (1).

Null texts count as empty. Of rows with the same doc_id the text of the smallest hash serves as next document. Rows with a null
doc_id stand outside the order: nothing follows them, they follow nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINE = r"[^\n]{1,120}+\n*+|\n++"
BEGIN, BEGIN_LINE = 240, r"[^\n]{1,24}+\n*+|\n++"
PART = 4  # digests of a part, about
SIZES = [12, 36, 108]  # cells, tried in order
ROUNDS = 8
RANGES = 256  # of doc_id, to find neighbours without sorting in one task
_LOW = (1 << 48) - 1


def digests(text: Column) -> Column:
    """The distinct paragraphs' digests."""
    cut = F.concat(F.regexp_extract_all(F.substring(text, 1, BEGIN), F.lit(BEGIN_LINE), F.lit(0)),
                   F.regexp_extract_all(F.substring(text, BEGIN + 1, 2147483647), F.lit(LINE), F.lit(0)))
    low = F.transform(cut, lambda p: F.xxhash64(p).bitwiseAND(F.lit(_LOW)))
    return F.array_distinct(F.transform(low, _checked))


def _checked(low: Column) -> Column:
    return low.bitwiseOR(F.shiftleft(F.xxhash64(low), 48))


def _cell(n: Column, key: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("key"))


def _inside(key: Column, i: Column, size: int) -> Column:
    """Whether the digest goes into cell i: one cell in each third of the table."""
    third = size // 3
    places = [F.shiftright(key, 12 * (t + 1)).bitwiseAND(F.lit(0xFFF)) % third + t * third for t in range(3)]
    return (places[0] == i) | (places[1] == i) | (places[2] == i)


def _numbers(size: int) -> Column:
    return F.array(*[F.lit(i) for i in range(size)])


def sketch(keys: Column, size: int) -> Column:
    """The table of an array of digests: size cells (n, key)."""

    def cell(i: Column) -> Column:
        return F.aggregate(keys, _cell(F.lit(0), F.lit(0).cast("bigint")), lambda c, key: F.when(
            _inside(key, i, size), _cell(c["n"] + 1, c["key"].bitwiseXOR(key))).otherwise(c))

    return F.transform(_numbers(size), cell)


def peeled(ours: Column, theirs: Column, size: int) -> Column:
    """The differing digests as (n: 1 ours or -1 theirs, key), from two tables; null if peeling fails."""
    less = F.zip_with(ours, theirs, lambda a, b: _cell(a["n"] - b["n"], a["key"].bitwiseXOR(b["key"])))

    def full(c: Column) -> Column:
        return (c["n"] != 0) | (c["key"] != 0)

    def single(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (_checked(c["key"].bitwiseAND(F.lit(_LOW))) == c["key"])

    def without(cells: Column, taken: Column) -> Column:
        return F.transform(cells, lambda c, i: F.aggregate(taken, c, lambda left, one: F.when(
            _inside(one["key"], i, size), _cell(left["n"] - one["n"], left["key"].bitwiseXOR(one["key"]))).otherwise(left)))

    def round_(state: Column, _: Column) -> Column:
        taken = F.array_distinct(F.filter(state["cells"], single))
        after = F.aggregate(F.array(taken), state, lambda s, t: F.struct(
            without(s["cells"], t).alias("cells"), F.concat(s["found"], t).alias("found")))
        return F.when(F.exists(state["cells"], full), after).otherwise(state)

    start = F.struct(less.alias("cells"), F.expr("cast(array() as array<struct<n:int,key:bigint>>)").alias("found"))
    return F.aggregate(_numbers(ROUNDS), start, round_, lambda s: F.when(F.exists(s["cells"], full), F.lit(None)).otherwise(s["found"]))


def differing(ours: Column, theirs: Column) -> Column:
    """The digests of one part that differ: by tables, larger ones after a failure; at last by the lists themselves."""
    tries = [peeled(sketch(ours, size), sketch(theirs, size), size) for size in SIZES]

    def signed(keys: Column, n: int) -> Column:
        return F.transform(keys, lambda k: _cell(F.lit(n), k))

    return F.coalesce(*tries, F.concat(signed(F.array_except(ours, theirs), 1), signed(F.array_except(theirs, ours), -1)))


def printed(cells: Column) -> Column:
    """A table as text."""
    return F.array_join(F.transform(cells, lambda c: F.concat(F.hex(c["n"]), F.lit("."), F.hex(c["key"]))), "-")


def parts(lists: list[Column]) -> Column:
    """An array with, for each part of the digests of any list, an array of the lists' digests there."""
    tagged = F.concat(*[F.transform(keys, _tagger(t)) for t, keys in enumerate(lists)])
    longest = F.greatest(*[F.size(keys) for keys in lists])
    mask = F.least(F.greatest(F.floor(F.pow(F.lit(2.0), F.ceil(F.log2(longest / PART)))), F.lit(1)), F.lit(4096)).cast("bigint") - 1
    placed = F.array_sort(F.transform(tagged, lambda x: F.struct(x["key"].bitwiseAND(mask).alias("part"), x["tag"].alias("tag"), x["key"].alias("key"))))
    empty = F.expr("cast(array() as array<struct<part:bigint,tag:int,key:bigint>>)")
    start = F.struct(F.expr("cast(array() as array<array<struct<part:bigint,tag:int,key:bigint>>>)").alias("done"), empty.alias("open"))

    def put(s: Column, x: Column) -> Column:
        same = (F.size(s["open"]) == 0) | (F.element_at(s["open"], 1)["part"] == x["part"])
        return F.when(same, F.struct(s["done"].alias("done"), F.concat(s["open"], F.array(x)).alias("open"))).otherwise(
            F.struct(F.concat(s["done"], F.array(s["open"])).alias("done"), F.array(x).alias("open")))

    grouped = F.aggregate(placed, start, put, lambda s: F.concat(s["done"], F.array(s["open"])))
    return F.transform(grouped, lambda g: F.array(*[_of_tag(g, t) for t in range(len(lists))]))


def _tagger(tag: int):
    return lambda key: F.struct(F.lit(tag).alias("tag"), key.alias("key"))


def _of_tag(group: Column, tag: int) -> Column:
    return F.transform(F.filter(group, lambda x: x["tag"] == tag), lambda x: x["key"])


def likeness(a: Column, b: Column, d: Column) -> Column:
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - d) / (a + b + d))


def neighbours(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id, n) from rows (doc_id, n) with distinct ids: the next lower id, after the lowest the highest.

    Ids are dealt over ranges of like size; a range's lowest id takes the highest of the range below, from a table of one row
    per range.
    """
    bounds = ids.agg(F.percentile_approx("doc_id", [i / RANGES for i in range(1, RANGES)], 10_000).alias("b")).first()["b"] or []
    within = F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<bigint>"), lambda b: b < F.col("doc_id")))
    ranged = ids.withColumn("range", within)
    tops = {r["range"]: r["top"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    lower = {name: tops[order[at - 1]] for at, name in enumerate(order)}
    below = F.get(F.array(*[F.lit(lower.get(i)).cast("bigint") for i in range(RANGES)]), F.col("range"))
    follows = F.lead("doc_id").over(Window.partitionBy("range").orderBy(F.desc("doc_id")))
    return ranged.select("doc_id", F.coalesce(follows, below).alias("next_id"), "n")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses to the edited text and the next document.

    Edited: the last third of the code points gives way to as many first ones of the next document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumn("key", F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    ids = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    gives = neighbours(ids).select(F.col("next_id").alias("key"), F.col("doc_id").alias("to"), F.floor(F.col("n") / 3).cast("int").alias("wanted"))
    # rows keep doc_id, key and text on both ways, so that the texts are shuffled once for both
    copies = Window.partitionBy("key").orderBy(F.col("doc_id").isNull(), F.xxhash64("text"))
    given = rows.join(gives, "key").withColumn("copy", F.row_number().over(copies)).where("copy = 1").select(
        F.col("to").alias("key"), F.expr("left(text, wanted)").alias("head"), digests(F.col("text")).alias("following"))
    nothing = F.expr("cast(array() as array<bigint>)")
    both = rows.join(given, "key", "left")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), F.substring(F.coalesce("head", F.lit("")), F.lit(1), third))
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"), F.coalesce("following", nothing).alias("c"))
    both = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
                       digests(F.col("edited")).alias("b"), "c")
    both = both.withColumn("parts", parts([F.col("a"), F.col("b"), F.col("c")]))

    def differ(other: int) -> Column:
        return F.aggregate("parts", F.lit(0), lambda total, p: total + F.size(differing(p[0], p[other])))

    both = both.withColumn("from_edited", differ(1)).withColumn("from_next", differ(2))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", printed(sketch(F.col("a"), SIZES[0])).alias("fingerprint"),
        printed(sketch(F.col("b"), SIZES[0])).alias("edited_fingerprint"),
        likeness(F.size("a"), F.size("b"), F.col("from_edited")).alias("near_edited"),
        likeness(F.size("a"), F.size("c"), F.col("from_next")).alias("near_next"))
