"""Near-duplicates by a chosen-path set similarity join on minwise tokens.

A document is the set of its five-word shingles. Documents with equal sets form a class, and one of each class goes on. A
signature holds the least of the set under each of 128 hash functions. In every tree a document walks from the root: the
node where it stands selects one of the 128, and the document's minwise token there names the child it goes to. Two documents
part at a step with the probability that their sets differ by, so alike ones tend to stay together
(Christiani and Pagh, "Set similarity search beyond MinHash", 2017; with Sivertsen, "Scalable and robust
set similarity join", 2018). Trees are independent and repeated, so that a pair at the threshold is missed by all with a
probability of about (1 - 0.75 ** 4) ** TREES = 1e-4.

Nodes of at most SMALL documents are compared exhaustively. Larger nodes branch on, and in those that are large at the last
step each document is compared with one of them, another in each tree. Comparisons count differing bits of signatures;
near pairs are confirmed on the full sets. As only components are asked for, this goes in two passes. First every member of a
node brings its nearest predecessor, a few over all trees, which connects dense groups at linear cost. Then near pairs across the components so
found are confirmed, the nearest pairs of two components first; nodes that one component fills are done. The other nodes that are
large at the first depth can hold crowds, distinct texts that share a template or a long passage, and no depth parts those
from links. All their documents together go through an exact join instead (``crowd_links``), so that what meets at the first
depth is found, whatever the node's size. Links are joined into components by star contraction.

Texts without words, empty or null, have the empty set and no links. Rows with a null doc_id cannot be named: their
component is null and they are kept. Rows with the same doc_id are one document with several texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramloom.llm.common import over_texts

SHINGLE = 5
COORDINATES = 128
TREES = 24
STEPS = (4, 5, 6)  # depths at which nodes are looked at
SMALL = 16
#: Bits of 128 that may differ: links of similarity 0.75 differ in 16 of them, with a standard deviation of 3.7.
MAX_BITS = 31
BLOCK = 512
CLASS = 1.05  # ratio of the sizes of neighbouring classes
FIRST = 4  # nearest predecessors that a document brings in the first pass
NEAREST = 8  # pairs of two components confirmed before the others
UNIT = 1 << 16  # shingles of a unit, on average: 512 KB
GUESTS = 64
SLOTS = 1 << 20  # of the filter of ids
LEAST = 75  # links: 100 * shared >= LEAST * united
CACHED_WORDS = 1 << 16  # some 8 MB a Python worker
_PRIME, _PRIME2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _PRIME
    x = (x ^ (x >> np.uint64(27))) * _PRIME2
    return x ^ (x >> np.uint64(31))


_seeds = _mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_roots = _mix(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Words(dict):
    """Hashes of words, remembered per task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, hashes: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles. Only A-Z are lower-cased; ASCII white space parts words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    rolled = np.full(n, size, np.uint64)
    for k in range(size):
        rolled = _mix(rolled * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n])
    return np.unique(rolled)


def signature(found: np.ndarray) -> np.ndarray:
    """The least hash under each function, as 32 bits."""
    least = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 1024):
        part = found[at:at + 1024]
        np.minimum(least, ((part[None, :] ^ _seeds[:, None]) * _PRIME).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sets_of(text: Column) -> Column:
    """Struct of n (set size), digest (null for the empty set) and sig of each text."""

    def make():
        hashes = _Words()

        def one(text):
            found = shingles(text, hashes)
            if not len(found):
                return {"n": 0, "digest": None, "sig": None}
            return {"n": len(found), "digest": blake2b(found.tobytes(), digest_size=16).digest(), "sig": signature(found).tobytes()}

        return lambda texts: pa.array([one(t) for t in texts], pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary())]))

    return over_texts(make, "struct<n:bigint,digest:binary,sig:binary>")(text)


def marked_sets(slot: Column, text: Column, marks: bytes) -> Column:
    """The sorted shingle hashes as bytes, of the rows whose slot is marked; null for the others."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = _Words()
        for slots, texts in batches:
            yield pa.array([shingles(t.as_py(), hashes).tobytes() if marks[s >> 3] >> (s & 7) & 1 else None
                            for s, t in zip(slots.to_pylist(), texts)], pa.binary())

    return run.asNondeterministic()(slot, text)


def _unpacked(sets: Column) -> Column:
    """The hashes of stored sets."""

    @F.arrow_udf("array<bigint>")
    def run(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(p.as_py(), np.int64) for p in packed], pa.list_(pa.int64()))

    return run(sets)


def walks(reps: DataFrame) -> DataFrame:
    """For each (rep, sig) and tree: the nodes at the depths of STEPS, and the signature's 128 low bits."""
    names = [f"node{d}" for d in STEPS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
                rows = np.arange(len(sig))[:, None]
                node = np.repeat(_roots[None, :], len(sig), 0)
                kept = []
                with np.errstate(over="ignore"):
                    for depth in range(1, STEPS[-1] + 1):
                        selected = (node >> np.uint64(17)) % np.uint64(COORDINATES)
                        node = _mix(node + (selected << np.uint64(32)) + sig[rows, selected.astype(np.int64)])
                        if depth in STEPS:
                            kept.append(node.view(np.int64).ravel())
                bits = np.packbits((sig & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("rep").to_numpy(), TREES)), *map(pa.array, kept),
                     pa.array(np.repeat(bits[:, 0], TREES)), pa.array(np.repeat(bits[:, 1], TREES))],
                    names=["rep", *names, "b0", "b1"])

    return reps.select("rep", "sig").mapInArrow(run, "rep bigint, " + ", ".join(f"{n} bigint" for n in names) + ", b0 bigint, b1 bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a["b0"].bitwiseXOR(b["b0"])) + F.bit_count(a["b1"].bitwiseXOR(b["b1"]))


def _pair(x: Column, y: Column) -> Column:
    return F.struct(F.least(x["rep"], y["rep"]).alias("a"), F.greatest(x["rep"], y["rep"]).alias("b"), _distance(x, y).alias("bits"))


def _predecessors(members: Column) -> Column:
    """For each of a short array of (rep, b0, b1): the near pair with the nearest one before it."""

    def nearest(x: Column, i: Column) -> Column:
        before = F.slice(members, 1, i)
        return F.array_min(F.transform(before, lambda y: F.struct(_distance(x, y).alias("d"), _pair(x, y).alias("p"))))

    found = F.transform(members, lambda x, i: F.when(i > 0, nearest(x, i)))
    return F.transform(F.filter(found, lambda n: (n["d"] <= MAX_BITS) & (n["p"]["a"] != n["p"]["b"])), lambda n: n["p"])


def _across(members: Column) -> Column:
    """All near pairs of a short array of (rep, b0, b1, component) that lie in two components."""
    return F.flatten(F.transform(members, lambda x, i: F.transform(
        F.filter(F.slice(members, i + 2, F.size(members)), lambda y: (y["component"] != x["component"]) & (_distance(x, y) <= MAX_BITS)),
        lambda y: _pair(x, y))))


def grown(nodes: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (node, rep, b0, b1, size) of small nodes of all depths, of nodes large at the last, and of those large at the first."""
    spark = nodes.sparkSession
    small, large = None, nodes
    for depth in STEPS:
        name = f"node{depth}"
        sized = large.withColumn("size", F.count("*").over(Window.partitionBy(name))).where("size > 1")
        sized.write.parquet(f"{folder}/nodes{depth}")
        sized = spark.read.parquet(f"{folder}/nodes{depth}")
        members = sized.select(F.col(name).alias("node"), "rep", "b0", "b1", "size")
        here = members.where(f"size <= {SMALL}")
        small = here if small is None else small.union(here)
        if depth == STEPS[0]:
            crowded = members.where(f"size > {SMALL}")
        large = sized.where(f"size > {SMALL}").drop("size")
    return small, members.where(f"size > {SMALL}"), crowded


def first_pairs(small: DataFrame, dense: DataFrame) -> DataFrame:
    """Near pairs (a, b, bits) that connect what is alike in a node: nearest predecessors, and stars of dense nodes.

    Each document brings its FIRST nearest ones over all trees. What they leave apart, the second pass looks at in full.
    """
    member = F.struct("rep", "b0", "b1")
    chains = small.groupBy("node").agg(F.sort_array(F.collect_list(member)).alias("m")).select(
        F.explode(_predecessors(F.col("m"))).alias("p")).select(F.col("p.b").alias("by"), "p.*")
    pivots = dense.groupBy("node").agg(F.min(F.struct(F.xxhash64("rep", "node").alias("h"), "rep", "b0", "b1")).alias("pivot"))
    star = dense.join(pivots, "node").select(F.col("rep").alias("by"), _pair(member, F.col("pivot")).alias("p")).select(
        "by", "p.*").where(f"a != b and bits <= {MAX_BITS}")
    found = chains.union(star).groupBy("by", "a", "b").agg(F.min("bits").alias("bits"))
    place = F.row_number().over(Window.partitionBy("by").orderBy("bits", "a", "b"))  # some of one document's trees each
    return found.withColumn("place", place).where(f"place <= {FIRST}").select("a", "b", "bits").distinct()


def in_components(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with the component of their rep among the known components (id, component)."""
    known = known.select(F.col("id").alias("rep"), "component")
    return rows.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def second_pairs(small: DataFrame) -> DataFrame:
    """Near pairs (a, b, bits) across components, of the named members of small nodes."""
    member = F.struct("rep", "b0", "b1", "component")
    mixed = small.groupBy("node").agg(F.collect_list(member).alias("m"), F.min("component").alias("l"), F.max("component").alias("h"))
    pairs = mixed.where("l != h").select(F.explode(_across(F.col("m"))).alias("p")).select("p.*")
    return pairs.groupBy("a", "b").agg(F.min("bits").alias("bits"))


def _class(n: Column) -> Column:
    """Class of a set size: the size itself below 32, then steps of CLASS."""
    return F.when(n < 32, n).otherwise(32 + F.floor(F.log(n / 32) / math.log(CLASS))).cast("int")


def _overlap(n: Column, m: Column) -> Column:
    """How many shingles sets of n and m must share to be linked."""
    return F.ceil(LEAST * (n + m) / (100 + LEAST) - 1e-6)


def crowd_links(rows: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) across components, of the named members of large nodes that no component fills: one at least of each
    two components that have any.

    An exact prefix filter over the full sets (Xiao and others, "Efficient similarity joins for near duplicate detection",
    2008). Shingles stand in one order: first those of a single component, then the others, rare ones before common ones.
    Where linked sets first agree in it, each has as many shingles to come as they must share. What a crowd has
    in common stands last, and is too little for that unless the crowd is at the threshold. A posting is a shingle and
    two classes of sizes; in it, those outside its most frequent component are compared with all, in blocks.

    What is compared are units, parts of a component of about UNIT shingles: a text that many near copies might be linked
    with meets their units, not each of them. Units that meet have all their full sets compared (``unit_links``).
    """
    mixed = rows.groupBy("node").agg(F.min("component").alias("l"), F.max("component").alias("h")).where("l != h").select("node")
    crowd = _stored(rows.join(mixed, "node", "left_semi").select("rep", "component").distinct(), f"{folder}/crowd")
    sets = stored_sets(crowd.select(F.col("rep").alias("doc_id")), docs, f"{folder}/crowd_sets").withColumnRenamed("doc_id", "rep")
    # an id can have several texts, which are ranked each on its own
    sizes = sets.select("rep", F.xxhash64("s").alias("text"), (F.octet_length("s") / 8).cast("bigint").alias("n")).distinct()
    weight = sizes.groupBy("rep").agg(F.sum("n").alias("w")).join(crowd, "rep")
    parts = weight.groupBy("component").agg(F.ceil(F.sum("w") / UNIT).alias("parts"))
    placed = weight.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    weights = placed.groupBy("component", "part").agg(F.sum("w").alias("w"))
    placed = _stored(placed.drop("w", "parts").join(weights, ["component", "part"]).select(
        "rep", F.struct("w", "component", "part").alias("unit")), f"{folder}/placed")
    units = _stored(sets.join(placed, "rep").groupBy("unit").agg(F.collect_list(F.struct("rep", "s")).alias("held")), f"{folder}/units")

    held = sets.join(crowd, "rep").select("rep", "component", F.xxhash64("s").alias("text"), F.explode(_unpacked(F.col("s"))).alias("shingle"))
    own = Window.partitionBy("shingle")
    held = held.select("rep", "text", "shingle", F.count("*").over(own).alias("held"),
                       (F.min("component").over(own) != F.max("component").over(own)).alias("shared")).where("shared")
    ranked = held.withColumn("r", F.row_number().over(Window.partitionBy("rep", "text").orderBy(F.desc("held"), "shingle")))
    n, r, other = F.col("n"), F.col("r"), F.col("other")
    posts = ranked.select("rep", "text", "shingle", "r").join(sizes, ["rep", "text"]).where(100 * r >= LEAST * n)
    posts = posts.withColumn("class", _class(n)).withColumn("other", F.explode(F.sequence(
        _class(F.ceil(LEAST * n / 100)), _class(F.floor(100 * n / LEAST)))))
    least = F.when(other < 32, other).otherwise(F.floor(32 * F.pow(F.lit(CLASS), other - 32) - 1e-6))
    posts = posts.where(r >= _overlap(n, least)).join(placed, "rep")
    post = F.xxhash64("shingle", F.least("class", "other"), F.greatest("class", "other")).alias("post")
    # of a unit's sets in a posting, the bounds that let most pass
    posts = posts.groupBy(post, "class", "other", "unit").agg(F.min("n").alias("n"), F.max("r").alias("r"))
    posts = _stored(posts.select("post", "class", "other", F.struct("unit", "n", "r").alias("x")), f"{folder}/posts")

    parts = posts.groupBy("post", F.col("x.unit.component").alias("component")).agg(F.count("*").alias("k"))
    parts = parts.groupBy("post").agg(F.sum("k").alias("size"), F.max("k").alias("most"), F.max_by("component", F.struct("k", "component")).alias("main"))
    posts = posts.join(parts.where("most < size").drop("most"), "post")
    blocks = F.ceil(F.col("size") / BLOCK)
    members = posts.select("post", F.pmod(F.xxhash64("x.unit"), blocks).alias("block"), "class", "x")
    others = posts.where("x.unit.component != main").select("post", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"),
                                                            F.col("other").alias("class"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    both = members.join(others, ["post", "block", "class"]).where(
        (x["unit"]["component"] != y["unit"]["component"]) & (F.least(x["r"], y["r"]) >= _overlap(x["n"], y["n"])))
    both = both.select(F.greatest("x.unit", "y.unit").alias("home"), F.least("x.unit", "y.unit").alias("guest")).distinct()
    return unit_links(_stored(both, f"{folder}/meetings"), units)


def unit_links(meetings: DataFrame, units: DataFrame) -> DataFrame:
    """A link (a, b) of each two units (home, guest) whose documents have one; units are (unit, held), held (rep, s).

    The heavier unit is the home. About GUESTS of its guests come to a task together, so its sets go there once for them.
    """

    def links(home: pa.Table, guests: pa.Table) -> pa.Table:
        out = [[], []]
        if home.num_rows:
            held = home.column("of_home")[0].as_py()
            sets = [np.frombuffer(h["s"], np.uint64) for h in held]
            sizes = np.array([len(s) for s in sets])
            values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for guest in guests.column("of_guest"):
                for g in guest.as_py():
                    own = np.frombuffer(g["s"], np.uint64)
                    first, past = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                    many = past - first
                    at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    shared = np.bincount(owner[at], minlength=len(sets))
                    linked = np.flatnonzero(100 * shared >= LEAST * (len(own) + sizes - shared))
                    if len(linked):  # all others of the two units are known to hang together
                        out[0].append(g["rep"])
                        out[1].append(held[linked[0]]["rep"])
                        break
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    def place(share: Column) -> Column:
        return F.concat_ws(" ", "home.component", "home.part", share).alias("place")

    shares = meetings.groupBy("home").agg(F.ceil(F.count("*") / GUESTS).alias("shares"))
    guests = meetings.join(shares, "home").select("guest", place(F.pmod(F.xxhash64("guest"), "shares")))
    guests = guests.join(units.withColumnRenamed("unit", "guest"), "guest").select("place", F.col("held").alias("of_guest"))
    homes = shares.withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))
    homes = homes.join(units.withColumnRenamed("unit", "home"), "home").select(place(F.col("share")), F.col("held").alias("of_home"))
    return homes.groupBy("place").cogroup(guests.groupBy("place")).applyInArrow(links, "a bigint, b bigint")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def stored_sets(ids: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, s): the full sets of the documents of ids.

    A filter of fixed size, a mark for each hash of an id, spares most other texts the work and the join.
    """
    slot = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int"), F.lit(0))
    words = ids.select(slot.alias("s")).groupBy(F.expr("s div 32 as w")).agg(
        F.expr("bit_or(shiftleft(1L, s % 32)) as bits")).collect()  # at most SLOTS / 32 rows
    marks = bytearray(SLOTS // 8)
    for r in words:
        marks[4 * r["w"]:4 * r["w"] + 4] = r["bits"].to_bytes(4, "little")
    found = docs.select("doc_id", marked_sets(slot, F.col("text"), bytes(marks)).alias("s")).where("s is not null")
    found.join(ids, "doc_id", "left_semi").write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    @F.arrow_udf("boolean")
    def linked(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            shared = 0
            if 100 * min(len(x), len(y)) >= LEAST * max(len(x), len(y)):
                shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * shared >= LEAST * (len(x) + len(y) - shared))
        return pa.array(out, pa.bool_())

    rows = pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
    rows = rows.join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    return rows.select("a", "b", linked("sa", "sb").alias("ok")).where("ok").select("a", "b").distinct()


def _stored(frame: DataFrame, folder: str) -> DataFrame:
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (v, u), u < v, is either a leaf of one edge or a centre: then u is the smallest id of all."""
    nodes = edges.select(F.col("v").alias("id"), F.lit(1).alias("leaf")).union(edges.select("u", F.lit(0)))
    return nodes.groupBy("id").agg(F.sum("leaf").alias("edges"), F.min("leaf").alias("least")).where("edges > least").isEmpty()


def components(links: DataFrame, folder: str) -> DataFrame:
    """(id, component) of all ids in links (a, b): the smallest id that can be reached.

    Large and small stars alternate (Kiveris and others, 2014) until all edges are stars; the edges of each round are
    written to ``folder``. Links that are stars to begin with take no round.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    edges, turn = _stored(edges, f"{folder}/round0"), 0
    while not _stars(edges):
        turn += 1
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        edges = joined.where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u"))).where("u < v").distinct()
        edges.write.parquet(f"{folder}/round{turn}")
        edges = spark.read.parquet(f"{folder}/round{turn}")
    found = edges.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return found.union(found.select(F.col("component").alias("id"), "component").distinct())


def _between(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs with the components of both ends as (low, high)."""
    for end in ("a", "b"):
        pairs = pairs.join(known.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    of_a, of_b = F.coalesce("of_a", "a"), F.coalesce("of_b", "b")
    return pairs.select("a", "b", "bits", F.least(of_a, of_b).alias("low"), F.greatest(of_a, of_b).alias("high"))


def near_duplicates(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text).

    ``folder`` is a new folder that all executors share, for the tables between the steps.
    """
    spark = docs.sparkSession
    docs.select("doc_id", sets_of(F.col("text")).alias("s")).select("doc_id", "s.*").write.parquet(f"{folder}/signatures")
    signed = spark.read.parquet(f"{folder}/signatures")
    named = signed.where("doc_id is not null and digest is not null")
    named.groupBy("digest", "sig").agg(F.min("doc_id").alias("rep")).write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    small, dense, crowded = grown(walks(classes), folder)
    pairs = _stored(first_pairs(small, dense), f"{folder}/pairs1")
    links = _stored(confirmed(pairs, stored_sets(ends(pairs), docs, f"{folder}/sets1")), f"{folder}/links1")
    known = components(links, f"{folder}/known1")

    # across components: what large nodes hold, and the nearest pairs of each two from small ones, then all of those still apart
    crowded = _stored(crowd_links(in_components(crowded, known), docs, folder), f"{folder}/crowd_links")
    pairs = second_pairs(in_components(small, known)).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    pairs = _stored(_between(pairs, known).withColumn("rank", F.row_number().over(
        Window.partitionBy("low", "high").orderBy("bits", "a", "b"))), f"{folder}/pairs2")
    sets = stored_sets(ends(pairs), docs, f"{folder}/sets2")
    nearest = _stored(confirmed(pairs.where(f"rank <= {NEAREST}"), sets), f"{folder}/links2")
    again = known.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a != b").union(nearest).union(crowded)
    known = components(again, f"{folder}/known2")
    rest = _between(pairs.where(f"rank > {NEAREST}").select("a", "b", "bits"), known).where("low != high")
    more = confirmed(rest, sets)
    # classes whose documents share an id, and both rounds of links, meet here
    same = named.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest").where("doc_id != rep")
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    same = same.join(repeated, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    again = known.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a != b").union(more).union(same)
    final = components(again, f"{folder}/final")
    groups = classes.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(groups, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
