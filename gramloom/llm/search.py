"""Ranked lexical search: accumulator-limited term-at-a-time over an inverted index of the query words.

The index holds postings (doc, term, tf) of the terms that some query asks for, and for every document its number
of terms n, from which the length norm m follows. Each query's distinct terms are taken rarest first. A round adds the
postings of every query's next terms to its accumulators (blocks of steps that double in length, so a question of t
terms takes about log2 t rounds): documents already there are updated; new documents get an accumulator only while the upper bound of the query's remaining terms (their weight times the largest impact any
posting of theirs has) can still reach the k-th best partial score. Once it cannot, the query admits nobody again,
and its survivors are scored exactly over all of its terms in one join. A document refused an accumulator scores
below that k-th partial score, which only grows, so the top k are exact (ties by ascending doc_id, nulls last).

Scoring, all 64-bit integers but the weight: w = floor(1000 * ln((2N + 2) / (2 df + 1))),
m = 25 + (75 n N) div L, impact = (10^9 tf) div (1000 tf + 8 m), score = sum over the query's terms, repeats
included, of w * impact. N counts documents with a term, L all their terms.

Rows of the documents are documents, also where ids repeat or are null (they are told apart by a row key written
with the index); null and empty texts have no terms and count neither in N nor in L. Queries without terms, or
whose terms are in no document, return nothing; an empty table of documents returns nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramloom.session import fresh_dir

# fixed values of the contract: the term pattern, the letters lower-cased, the constants of the score
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10
MAX_BROADCAST = 1_000_000  # rows of query terms or survivors sent to every task; beyond it they are joined by shuffle


SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # runs of what TERM excludes


def terms(text: Column) -> Column:
    """The terms of a text in order, repeats kept; a null text has none.

    The maximal matches of TERM are the pieces between runs of SEPARATORS, empty ones dropped; splitting is some
    three times cheaper than extracting the matches.
    """
    pieces = F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")
    return F.coalesce(pieces, F.array().cast("array<string>"))


def _broadcast_if_small(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= MAX_BROADCAST else frame


def counted(frame: DataFrame, sorted_terms: str) -> tuple[DataFrame, Column]:
    """(term, tf) of every distinct term of a sorted array column: its runs, found without leaving the row."""
    t = f"`{sorted_terms}`"
    starts = F.expr(f"CASE WHEN size({t}) = 0 THEN array() ELSE "
                    f"filter(sequence(1, size({t})), i -> i = 1 OR {t}[i - 1] != {t}[i - 2]) END")
    with_starts = frame.withColumn("_starts", starts)
    runs = F.expr(f"""transform(_starts, (st, k) -> named_struct('term', {t}[st - 1],
                  'tf', CAST(coalesce(try_element_at(_starts, k + 2), size({t}) + 1) - st AS BIGINT)))""")
    return with_starts, runs


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a table this job wrote and no longer reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def index(docs: DataFrame, wanted: DataFrame, folder: str) -> tuple[DataFrame | None, dict]:
    """Postings (key, doc_id, term, tf, impact) of the wanted terms, and the totals N and L.

    ``docs`` has doc_id and text; ``wanted`` the distinct terms of the queries. One pass over the texts writes the
    index: a row of (key, doc_id, n) for every document, and one more for each distinct wanted term it holds, its tf
    counted from the runs of the sorted terms inside the row, so nothing is shuffled. n, N and L count all terms.
    Files are sorted by term, so that a round's scan skips row groups of other terms.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.array_sort(terms(F.col("text").cast("string"))).alias("sorted"))
    alone = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("tf")))
    rows, runs = counted(rows, "sorted")
    entries = rows.select("key", "doc_id", F.size("sorted").cast("long").alias("n"), F.explode(F.concat(alone, runs)).alias("p"))
    flags = wanted.select("term", F.lit(True).alias("wanted"))
    flags = _broadcast_if_small(flags, flags.count())
    kept = entries.select("key", "doc_id", "n", "p.term", "p.tf").join(flags, "term", "left").where("term IS NULL OR wanted")
    kept.drop("wanted").sortWithinPartitions("term").write.parquet(f"{folder}/index")  # keys fixed once, before anything reuses them
    stored = spark.read.parquet(f"{folder}/index")
    totals = stored.where("term IS NULL AND n > 0").agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    big_n, big_l = int(totals["N"]), int(totals["L"] or 0)
    if big_n == 0:
        return None, {"N": 0, "L": 0}
    impact = F.expr(f"(1000000000L * tf) div (1000L * tf + 8L * (25L + (75L * n * {big_n}L) div {big_l}L))")
    return stored.where("term IS NOT NULL").select("key", "doc_id", "term", "tf", impact.alias("impact")), {"N": big_n, "L": big_l}


def search(docs: DataFrame, questions: DataFrame, spark: SparkSession | None = None, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents with a positive score for every question.

    ``docs`` has doc_id and text, ``questions`` item_id and text (other columns are ignored). Ranks run from 1,
    highest score first, equal scores by ascending doc_id (null ids last).
    """
    spark = spark or docs.sparkSession
    folder = fresh_dir(spark, "search")
    asked = (questions.select(F.col("item_id").cast("long").alias("item"), F.explode(terms(F.col("text").cast("string"))).alias("term"))
             .groupBy("item", "term").agg(F.count("*").alias("q")))
    asked.write.parquet(f"{folder}/asked")
    asked = spark.read.parquet(f"{folder}/asked")
    postings, totals = index(docs.select("doc_id", "text"), asked.select("term").distinct(), folder)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if postings is None:
        return empty
    big_n = totals["N"]
    stats = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("best"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * big_n + 2.0)) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    plan = asked.join(stats, "term").withColumn("w", weight).where("w > 0")
    rarest = Window.partitionBy("item").orderBy("df", "term")
    rest = Window.partitionBy("item").orderBy("df", "term").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    plan = plan.select("item", "term", "q", "w", (F.row_number().over(rarest) - 1).alias("step"),
                       F.sum(F.col("q") * F.col("w") * F.col("best")).over(rest).alias("bound"))
    plan.write.parquet(f"{folder}/plan")
    plan = spark.read.parquet(f"{folder}/plan")
    terms_of = {(r["item"], r["step"]): r for r in plan.collect()}  # the questions' terms: bounded by the benchmark
    accumulators = spark.createDataFrame([], "item long, key long, partial long")
    threshold: dict[int, int] = {}
    start, width = 0, 1
    while True:
        # a block of steps shares the k-th partial score of its start: lower than later ones, so it admits no fewer
        block = [r for (item, step), r in terms_of.items() if start <= step < start + width
                 and r["bound"] > 0 and r["bound"] >= threshold.get(item, 0)]
        if not block:
            break
        now = F.broadcast(spark.createDataFrame([(r["item"], r["term"], r["q"], r["w"]) for r in block], "item long, term string, q long, w long"))
        found = postings.where(F.col("term").isin(sorted({r["term"] for r in block}))).join(now, "term").select(
            "item", "key", (F.col("q") * F.col("w") * F.col("impact")).alias("partial"))
        # documents of admitted terms get or update accumulators; other terms are left to the exact pass
        merged = accumulators.unionByName(found).groupBy("item", "key").agg(F.sum("partial").alias("partial"))
        written = f"{folder}/accumulators-{start}"
        merged.write.parquet(written)
        if start:
            _drop(spark, f"{folder}/accumulators-{start - width // 2}")  # the previous round's, read no more
        accumulators = spark.read.parquet(written)
        best = Window.partitionBy("item").orderBy(F.desc("partial"))
        kth = accumulators.withColumn("r", F.row_number().over(best)).where(F.col("r") == top).select("item", "partial").collect()
        threshold.update({r["item"]: r["partial"] for r in kth})
        start, width = start + width, 2 * width
    survivors = accumulators.select("item", "key")
    survivors = _broadcast_if_small(survivors, survivors.count())
    scored = (survivors.join(postings, "key").join(F.broadcast(plan.select("item", "term", "q", "w")), ["item", "term"])
              .groupBy("item", "key", "doc_id").agg(F.sum(F.col("q") * F.col("w") * F.col("impact")).alias("score"))
              .where("score > 0"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("key"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
