"""Readers that turn files into a corpus: one row per record, (source_id, content)."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

TASK_BYTES = 4 << 20  # Parquet bytes of a task that makes n-grams: their counts fit its memory, so they need not spill


def load_corpus(
    spark: SparkSession,
    path: str | Sequence[str],
    column: str = "text",
    source_column: str | None = None,
    whole_text: bool = False,
    multiline_csv: bool = True,
) -> DataFrame:
    """Read text, CSV or Parquet, chosen by extension, as (source_id, content).

    ``source_id`` is ``source_column`` when given, the path as typed for one path, and
    the file's own URI for a list of paths. A missing path raises Spark's PATH_NOT_FOUND.

    Plain text is read in pieces ended by a full stop. A full stop always ends a sentence,
    so the sentences are those of the whole file, and one huge file still splits over many
    tasks. ``whole_text=True`` gives one row per file, which n-grams that run across
    sentences need. ``multiline_csv=False`` lets large CSV files split, for data known to
    have no line breaks inside quotes.
    """
    if isinstance(path, str):
        return spread(_read_one_kind(
            spark, path, column, source_column, F.lit(path), whole_text, multiline_csv), _extension(path) == "parquet", TASK_BYTES)
    if not path:
        raise ValueError("no paths given")
    kinds: dict[str, list[str]] = {}
    for p in path:
        kinds.setdefault(_extension(p), []).append(p)
    parts = [
        _read_one_kind(spark, paths, column, source_column, F.col("_metadata.file_path"),
                       whole_text, multiline_csv)
        for paths in kinds.values()
    ]
    corpus = parts[0]
    for part in parts[1:]:
        corpus = corpus.unionByName(part)
    return spread(corpus, set(kinds) == {"parquet"}, TASK_BYTES)


def _extension(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    return ext if ext in ("parquet", "csv") else "text"


def _read_one_kind(spark, path, column, source_column, name, whole_text, multiline_csv) -> DataFrame:
    kind = _extension(path if isinstance(path, str) else path[0])
    if kind == "parquet":
        rows = spark.read.parquet(*([path] if isinstance(path, str) else path))
    elif kind == "csv":
        rows = spark.read.csv(path, header=True, multiLine=multiline_csv, escape='"')
    elif whole_text:
        rows = spark.read.text(path, wholetext=True)
        column = "value"
    else:
        rows = spark.read.text(path, lineSep=".")
        column = "value"
    if source_column is not None and kind != "text":
        name = F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit(""))
    return rows.select(name.alias("source_id"), F.col(f"`{column}`").cast("string").alias("content"))


def spread(corpus: DataFrame, count_rows: bool = True, task_bytes: int | None = None) -> DataFrame:
    """Shuffle scanned rows when fewer tasks than the session has slots would hold any.

    A Parquet file with few row groups is read in few tasks, however many splits it has, so rows are counted per
    task, which Parquet answers from its footers. Other files split anywhere, and their splits are counted.
    With ``task_bytes``, rows are also shuffled when a task would get more than twice as many bytes of Parquet files,
    so the work of a task does not grow with the input.
    """
    slots = corpus.sparkSession.sparkContext.defaultParallelism
    if count_rows and task_bytes:
        per_task = corpus.select(F.spark_partition_id().alias("p"), "_metadata.file_path", "_metadata.file_size").groupBy("p", "file_path").agg(
            F.max("file_size").alias("size"))
        found = per_task.agg(F.count_distinct("p").alias("tasks")).crossJoin(  # one row
            per_task.groupBy("file_path").agg(F.max("size").alias("size")).agg(F.sum("size").alias("bytes"))).first()
        wanted = ceil((found["bytes"] or 0) / task_bytes)
        return corpus if found["tasks"] >= max(slots, wanted / 2) else corpus.repartition(max(4 * slots, wanted))
    if count_rows:
        filled = corpus.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p").alias("n")).first()["n"]
    else:
        filled = corpus.rdd.getNumPartitions()
    return corpus if filled >= slots else corpus.repartition(4 * slots)
