"""The corpus pipeline: documents through five operators, each stage written as Parquet and read again.

Stages keep the columns of documents, except the last. Null and empty texts pass all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramloom.llm import bpe, mixing, neardup, queries, secrets, toxicity
from gramloom.llm.common import free_name, spread, texts_of
from gramloom.session import fresh_dir


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, learnt from the labels, does not predict to be toxic."""
    found = free_name(docs, "found")
    scored = spread(docs).withColumn(found, toxicity.score(F.col("text").cast("string"), queries.toxicity_model(spark, sf_dir)))
    return scored.where(F.col(found)["score"] < 0.5).drop(found)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the document of the smallest id, once. Rows without an id stay."""
    groups = neardup.near_duplicates(spread(texts_of(docs)), fresh_dir(spark, "neardup"))
    kept = groups.where("kept and doc_id is not null").select("doc_id").distinct()
    copy = free_name(docs, "copy")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    named = docs.join(kept, "doc_id", "left_semi").withColumn(copy, F.row_number().over(first)).where(F.col(copy) == 1)
    return named.select(*docs.columns).union(docs.where("doc_id is null"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets replaced by their kind in brackets; n_chars follows the text."""
    found = secrets.find(texts_of(docs), fresh_dir(spark, "secrets")).where(F.size("spans") > 0)
    key, spans = free_name(docs, "key"), free_name(docs, "spans")
    found = found.select(F.col("key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key])
    rows = docs.withColumn(key, secrets.key_of(F.col("doc_id").cast("long"), F.col("text"))).join(found, key, "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(secrets.redacted(F.col("text"), F.col(spans)))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return rows.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their domains ask, the good ones at least as often as now."""
    mixture, _ = queries.fitted_mixture(spark, docs, sf_dir, keep=("good",))
    return mixing.mixed(docs, mixture)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids, and the number of bytes that the ids decode to."""
    encoded = spread(docs).select("doc_id", bpe.encode(F.col("text").cast("string")).alias("ids"))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.octet_length(bpe.decode(F.col("ids"))).cast("long").alias("n_bytes"))


STAGES = [("toxicity", without_toxic), ("MinHash near-dedup", without_copies), ("secret scans", without_secrets),
          ("mixing sources to target weights", mixed), ("byte-level BPE encoding and decoding", tokenised)]
ORACLE_SQL = None  # the first stage is a trained model; tests/llm/ compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        folder = fresh_dir(spark, f"pipeline-{n}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
