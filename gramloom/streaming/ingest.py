"""Incremental training from arriving files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gramloom.plans.model import AlreadyTrained, EmptyCorpus, TransitionModel


def stream_corpus(spark: SparkSession, folder: str, schema: str = "text string", column: str = "text",
                  glob: str = "*.parquet", files_per_batch: int = 1000, kind: str = "parquet") -> DataFrame:
    """A stream of (source_id, content) over the files of a ``kind`` (parquet, csv or text) that arrive in ``folder``.

    Each file is a source, named by its URI. Text files come in pieces ended by a full stop, as when read at once.
    """
    reader = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
    if kind == "text":
        files, column = reader.text(folder, lineSep="."), "value"
    elif kind == "csv":
        files = reader.schema(schema).csv(folder, header=True, multiLine=True, escape='"')
    else:
        files = reader.schema(schema).parquet(folder)
    return files.select(F.col("_metadata.file_path").alias("source_id"),
                        F.col(f"`{column}`").cast("string").alias("content"))


def train_from_stream(stream: DataFrame, model: TransitionModel, k: int, checkpoint: str,
                      force: bool = False) -> StreamingQuery:
    """Start a query that trains ``model`` with every micro-batch, then stops when caught up.

    The commit key of a batch is the streaming query's id, which Spark keeps in the checkpoint's own metadata, the
    batch number and a fingerprint of the batch's sources (their number and the sum of their hashes). A batch that is
    offered again after it was finished does nothing; one that failed half way left no commit row and is written anew.
    A new or deleted checkpoint is a new query id, whose batches are all looked at, and a batch number that comes back
    with other files is another key. An empty batch, or one without a single token, commits nothing and lets the
    stream go on. A source may arrive over several batches of one checkpoint. Sources that the model has from
    elsewhere are refused, unless ``force`` is set, and their texts are kept in :func:`refused_texts`.
    """
    owner: list[str] = []

    def train_batch(batch: DataFrame, number: int) -> None:
        if not owner:
            owner.append(query_id(model.spark, checkpoint))
        sources = batch.select(F.coalesce("source_id", F.lit("")).alias("s")).distinct().agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("s").cast("decimal(38,0)")).alias("h")).first()
        if not sources["n"]:
            return
        key = f"{owner[0]}:{number}:{sources['n']}-{sources['h']}"
        try:
            refused = model.train(batch, k, force=force, key=key, owner=owner[0]).refused
            left_out = batch.join(refused, F.coalesce(batch.source_id, F.lit("")) == refused.name, "left_semi")
            some = not refused.isEmpty()
        except AlreadyTrained:
            left_out, some = batch, True
        except EmptyCorpus:
            return
        if some:
            left_out.write.mode("overwrite").parquet(f"{model.path}/refused/key={owner[0]}-{number}")

    return (stream.writeStream.foreachBatch(train_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def refused_texts(model: TransitionModel) -> DataFrame:
    """(source_id, content, key) of all texts that streams brought and the guard left out."""
    schema = "source_id string, content string, key string"
    try:
        return model.spark.read.schema(schema).parquet(f"{model.path}/refused")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return model.spark.createDataFrame([], schema)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query of a checkpoint: Spark writes it to the metadata file when the query first starts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]
