"""Merkle manifest of a table: leaves per row, a binary tree per group, a tree over the groups' subroots.

H is the lowercase hex SHA-256 of its inputs concatenated, digests as hex text. A leaf is H of the encoded fields,
each ``-`` if null, else its UTF-8 byte count, ``:`` and its value (integers in decimal). Within a group leaves
ascend by doc_id (null ids first, equal ids by leaf, so equal rows sit side by side and either order gives the same
tree). While a group has several nodes, every two consecutive ones become their H, a last lone one its H alone;
what remains is the subroot (a lone leaf is its own subroot). Subroots, ordered by group (null first, then UTF-8
bytewise), give the root the same way.

Each level is one window pass: the window is the pair (group, position div 2), so a lead of 1 on the left slot and a
lag of 1 on the right slot are the sibling, and the left slot's row hashes the parent. No window spans a group, so a
group with a third of all rows is spread like any other. Positions come from one range-partitioned sort: each task
numbers its rows, and the offsets of (task, group) runs, one row per task and group, are summed on the driver.
Every level is written to the shared folder, so a lost executor recomputes one level at most.

Paths go down again: a node's path is its own (sibling, slot) and then its parent's path; the root's path is empty.
``proof_sha256`` is H of the path's siblings, leaf level first, and ``folded_root`` folds a (possibly altered) leaf
with them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramloom.session import fresh_dir

# fixed values of the contract: the fields of a leaf in their order, and the null marker
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NULL = "-"


def H(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit(NULL)).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    return H(*(encoded(columns[f]) for f in FIELDS))


def group_key(value: Column) -> Column:
    """A non-null key that sorts as the group: null first, then the values bytewise."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def positioned(frame: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """``frame`` (with g) and pos: the rank of a row within its g by ``order``, from 0, written below ``folder``."""
    spark = frame.sparkSession
    ranked = frame.orderBy(F.col("g"), *order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_mid"))
    ranked.write.parquet(f"{folder}/ranked")  # numbers fixed once
    ranked = spark.read.parquet(f"{folder}/ranked").withColumn("_idx", F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), 33))
    runs = ranked.groupBy("_part", "g").agg(F.min("_idx").alias("first"), F.count("*").alias("n")).collect()  # one row a task and group
    offsets, seen = [], {}
    for r in sorted(runs, key=lambda r: r["_part"]):
        offsets.append((r["_part"], r["g"], seen.get(r["g"], 0) - r["first"]))
        seen[r["g"]] = seen.get(r["g"], 0) + r["n"]
    shift = F.broadcast(spark.createDataFrame(offsets, "_part int, g string, shift long"))
    return ranked.join(shift, ["_part", "g"]).withColumn("pos", F.col("_idx") + F.col("shift")).drop("_part", "_mid", "_idx", "shift")


def climb(nodes: DataFrame, sizes: dict[str, int], folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels (g, pos, h, sib, slot) of every group's tree, leaves first, and its top (g, level, h).

    ``nodes`` holds (g, pos, h); ``sizes`` the number of nodes of each g.
    """
    spark = nodes.sparkSession
    size_of = F.broadcast(spark.createDataFrame(list(sizes.items()), "g string, n long"))
    nodes = nodes.join(size_of, "g")
    levels, tops, level = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("g", F.lit(level).alias("level"), "h"))
        if max(sizes.values()) <= 1:
            break
        pair = Window.partitionBy("g", F.expr("pos div 2")).orderBy("pos")
        slot = (F.col("pos") % 2).cast("int")
        sib = F.when(slot == 0, F.lead("h", 1).over(pair)).otherwise(F.lag("h", 1).over(pair))
        written = f"{folder}/level-{level}"
        nodes.where("n > 1").select("g", "pos", "h", "n", sib.alias("sib"), slot.alias("slot")).write.parquet(written)
        done = spark.read.parquet(written)
        levels.append(done)
        nodes = done.where("slot = 0").select("g", F.expr("pos div 2").alias("pos"), H(F.col("h"), F.coalesce("sib", F.lit(""))).alias("h"),
                                              F.expr("(n + 1) div 2").alias("n"))
        sizes = {g: (n + 1) // 2 for g, n in sizes.items()}
        level += 1
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    written = f"{folder}/tops"
    top.write.parquet(written)
    return levels, spark.read.parquet(written)


STEP = "array<struct<sib:string,slot:int>>"


def descend(levels: list[DataFrame], tops: DataFrame, paths_of_tops: DataFrame, folder: str) -> DataFrame:
    """(g, pos, path) of every leaf: its (sibling, slot) from the leaf level up; ``paths_of_tops`` (g, path) goes last."""
    spark = tops.sparkSession
    ends = tops.join(paths_of_tops, "g").select("g", "level", F.lit(0).cast("long").alias("pos"), "path")
    done = None  # the paths of the level above, as written
    for level in range(len(levels) - 1, -1, -1):
        parents = ends.where(F.col("level") == level + 1).select("g", "pos", "path")
        if done is not None:
            parents = parents.unionByName(done)
        step = F.array(F.struct(F.col("sib"), F.col("slot"))).cast(STEP)
        children = levels[level].select("g", "pos", "sib", "slot", F.expr("pos div 2").alias("ppos")).join(
            parents.withColumnRenamed("pos", "ppos"), ["g", "ppos"])
        written = f"{folder}/paths-{level}"
        children.select("g", "pos", F.concat(step, F.col("path")).alias("path")).write.parquet(written)
        done = spark.read.parquet(written)
    leaves = ends.where("level = 0").select("g", "pos", "path")
    return leaves if done is None else leaves.unionByName(done)


def fold(start: Column, path: Column) -> Column:
    """The top that a node and its path give."""
    return F.aggregate(path, start, lambda acc, e: F.when(e["sib"].isNull(), H(acc))
                       .when(e["slot"] == 0, H(acc, e["sib"])).otherwise(H(e["sib"], acc)))


def manifest(docs: DataFrame, altered: Column | None = None, spark: SparkSession | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``docs`` holds the fields (other columns are ignored, absent fields count as null). ``altered`` is a leaf
    recomputed from altered fields, or none; ``folded_root`` folds it (else the leaf) with the original path.
    """
    spark = spark or docs.sparkSession
    folder = fresh_dir(spark, "merkle")
    fields = {f: (F.col(f) if f in docs.columns else F.lit(None)) for f in FIELDS}
    rows = docs.select(group_key(fields["lang"]).alias("g"), fields["doc_id"].cast("long").alias("doc_id"),
                       leaf(fields).alias("leaf"), (altered if altered is not None else leaf(fields)).alias("altered"))
    rows = positioned(rows, [F.asc_nulls_first("doc_id"), F.col("leaf")], f"{folder}/leaves")
    sizes = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count("*").alias("n")).collect()}  # one row a group
    if not sizes:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    levels, tops = climb(rows.select("g", "pos", F.col("leaf").alias("h")), sizes, f"{folder}/groups")
    order = sorted(sizes)  # Python orders str by code point, as UTF-8 bytes order
    rank = F.broadcast(spark.createDataFrame(list(enumerate(order)), "pos long, lang string"))
    subroots = tops.select(F.col("g").alias("lang"), "h").join(rank, "lang")
    upper, top = climb(subroots.select(F.lit("").alias("g"), "pos", "h"), {"": len(order)}, f"{folder}/root")
    root = top.first()["h"]
    empty = F.array().cast(STEP)
    upward = descend(upper, top, spark.createDataFrame([("", [])], f"g string, path {STEP}"), f"{folder}/root-paths")
    of_groups = upward.join(rank, "pos").select(F.col("lang").alias("g"), "path")
    paths = descend(levels, tops, of_groups, f"{folder}/paths")
    whole = rows.join(paths, ["g", "pos"]).join(tops.select("g", F.col("h").alias("subroot")), "g")
    proof = H(F.array_join(F.transform(F.coalesce("path", empty), lambda e: e["sib"]), ""))
    folded = fold(F.col("altered"), F.col("path"))
    return whole.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), proof.alias("proof_sha256"),
                        folded.alias("folded_root"), (folded == F.lit(root)).alias("verified"))
