"""Where jobs put the tables that cut their lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_READ_BYTES = "spark.sql.files.maxPartitionBytes"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20
SMALL_READ = 16 << 20  # stored counts are small on disk, some 9 bytes a row, so a task reads fewer bytes than by default
#: For tables stored in the order of state_key: zstd, and state keys as what differs from the one before.
SORTED_FILES = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary#state_key": "false"}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent and the session
    runs in local mode, where driver and executors are one process.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(_CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="gramloom-")
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder name below the shared one that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def small_reads(spark: SparkSession) -> None:
    """Let a task of this session read at most ``SMALL_READ`` bytes of files, so that what it counts fits its memory."""
    if _bytes(spark.conf.get(_READ_BYTES)) > SMALL_READ:
        spark.conf.set(_READ_BYTES, str(SMALL_READ))


def small_batches(spark: SparkSession) -> None:
    """Let Python workers of this session get at most ``BATCH_ROWS`` rows at once, and no more than fill ``BATCH_BYTES``, so
    that a batch of whole texts is small."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if not 0 < _bytes(spark.conf.get(_BATCH_SIZE)) <= BATCH_BYTES:
        spark.conf.set(_BATCH_SIZE, str(BATCH_BYTES))


def _bytes(size: str) -> int:
    """A size as Spark's settings give it: a number with an optional unit, such as 134217728b or 64MB."""
    number = size.lower().rstrip("bkmgtp")
    return int(number) * 1024 ** " kmgtp".index((size.lower()[len(number):] or " ")[0].replace("b", " "))


@contextmanager
def open_files(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Partitioned writes keep this many files of a task open, so that they need not sort rows by their partition first."""
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, str(max(files, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job inside go when the job ends, not when the driver's JVM collects its garbage.

    For chains of jobs that store what they make: the disk then holds the shuffles of one job at a time.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def by_part_of_the_keys(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside leave a table where it is that is clustered by some of the join's keys; the other side comes to it."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to a fresh folder and read back, so that Spark knows their size."""
    folder, spark = fresh_dir(rows.sparkSession, label), rows.sparkSession
    with tidy(spark):
        rows.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
