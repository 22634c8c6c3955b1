"""What the operators of this subpackage share: reading tables, running per text, fold rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from gramloom.session import small_batches
from gramloom.sources import corpus

__all__ = ["WORD", "fold", "free_name", "hash_share", "over_texts", "row_share", "sample_of", "spread", "table", "texts_of"]

WORD = r"[^\x20\x09-\x0D]+"  # the word of all contracts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows with whole texts, shuffled when too few tasks hold any; they go to Python workers in small batches."""
    small_batches(rows.sparkSession)
    return corpus.spread(rows)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that other columns of a table never clash with results."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def over_texts(make: Callable[[], Callable[[list], pa.Array]], returns: str | DataType):
    """A vectorised function of one text column.

    ``make`` runs once per task and returns what turns a list of texts (None for null) into an Arrow array.
    """

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield work(batch.to_pylist())
        pa.default_memory_pool().release_unused()  # the worker lives on for other tasks

    return run.asNondeterministic()  # so that a plan never evaluates it twice for one row


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo: the split into learning and held-out rows. A null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)), F.lit(0))


def hash_share(column: Column, share: float) -> Column:
    """True for about this share of the values of a column, chosen by hash, so the same on every run."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def row_share(id_column: str, text_column: str, share: float) -> Column:
    """As hash_share of the ids, but rows without an id are chosen by their text, since all nulls have one hash."""
    text = F.col(text_column)
    return F.when(F.col(id_column).isNull(), hash_share(text, share)).otherwise(hash_share(F.col(id_column), share))


def free_name(frame: DataFrame, stem: str) -> str:
    """The stem, with underscores before it until no column of the frame has that name."""
    taken = {c.lower() for c in frame.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def sample_of(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, text, column) of about ``per_class`` documents of each class 0 and 1, or of all where there are fewer.

    The ids are chosen by hash from ``labels`` (one row per doc_id), so there are at most about 2 * per_class of them, and
    they are sent to the texts.
    """
    labels = labels.where(F.col(column).isin(0, 1)).select("doc_id", F.col(column).cast("int").alias(column))
    chosen = F.lit(False)
    for r in labels.groupBy(column).agg(F.count("*").alias("n")).collect():
        chosen |= (F.col(column) == r[column]) & hash_share(F.col("doc_id"), min(1.0, per_class / r["n"]))
    return texts_of(docs).where("text is not null").join(F.broadcast(labels.where(chosen)), "doc_id")
