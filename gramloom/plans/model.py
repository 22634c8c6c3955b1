"""The persisted model: append-only batches of counts, made visible by commit rows.

Layout below the model's path::

    counts/batch=<b>/ord=<o>/     tally rows of one batch (ord 1..9 transitions, <= 0 bookkeeping; zstd)
    vocabulary/batch=<b>/         (id, token, freq) increments; id is set in a token's first row
    documents/batch=<b>/          one row per source trained
    training_runs/batch=<b>/      one row per source and order
    generation_runs/batch=<b>/    one row per walk recorded, with its id
    generation_steps/batch=<b>/   the step log of those walks
    refused/key=<key>/            texts of a stream that the guard left out
    commits/                      one row per finished batch, written last

A batch that fails leaves no commit row, so readers never see it and a retry overwrites it.
Counts merge when read; :meth:`TransitionModel.compact` folds the batches into one.
One job at a time may write to a model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from gramloom.functions.tokens import MAX_ORDER
from gramloom.operators.ranking import dense_ids, joined_with_heavy_split
from gramloom.operators.tally import GRAMS, LEDGER, VOCABULARY, ledgers, longest, shorter
from gramloom.session import SMALL_READ, SORTED_FILES, fresh_dir, open_files, small_reads, tidy

_COUNTS = "ord tinyint, state_key string, next_token string, n long, batch string"
_VOCABULARY = "id long, token string, freq long, batch string"
_DOCUMENTS = "id long, name string, added_at timestamp, token_count long, batch string"
_RUNS = "id long, document_id long, ord tinyint, ngrams_added long, ran_at timestamp, batch string"
_COMMITS = ("commit_id long, batch string, kind string, commit_key string, "
            "last_token_id long, last_document_id long, last_run_id long, last_generation_id long, committed_at timestamp")
_GENERATIONS = "id long, run_id long, seed string, requested_order tinyint, max_tokens int, created_at timestamp, batch string"
_STEPS = ("id long, run_id long, step int, state_key string, order_used tinyint, next_token string, chosen_prob double, "
          "n_candidates long, batch string")
_SKETCHES = "ord tinyint, states binary, transitions binary"
_FILES = SORTED_FILES | {"parquet.block.size": SMALL_READ}  # row groups as small as what a task reads
SKETCHES, SKETCH_BITS = "hash_sketches", 12  # their folder, and log2 of the buckets of a sketch
NAMES_SENT = 100_000  # refused source names up to this many are sent to the texts

# Which batches a reader starts from: the last one of these kinds, or the first batch.
_COUNT_BASES = ("prune", "compact", "rebuild")
_VOCABULARY_BASES = ("compact",)


class AlreadyTrained(ValueError):
    """Every source of the corpus is in the model already."""


class EmptyCorpus(ValueError):
    """The corpus holds no record with a token."""


@dataclass(frozen=True)
class TrainReport:
    """What a training call did; the tables themselves stay distributed."""

    batch: str | None
    refused: DataFrame   # (name): sources left out because the model has them


class TransitionModel:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        small_reads(spark)

    # ---- commits -------------------------------------------------------------------

    def commits(self) -> list[Row]:
        """Commit rows, oldest first: one per training, pruning or compaction call."""
        try:
            rows = self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({r.commit_id: r for r in rows}.values(), key=lambda r: r.commit_id)  # a fold may briefly double rows

    def _commit(self, last: Row | None, batch: str, kind: str, key: str | None, **ids: int) -> None:
        known = {n: getattr(last, n) if last else 0
                 for n in ("last_token_id", "last_document_id", "last_run_id", "last_generation_id")}
        known.update(ids)
        (self.spark.range(1).select(
            F.lit(last.commit_id + 1 if last else 1).cast("long").alias("commit_id"),
            F.lit(batch).alias("batch"), F.lit(kind).alias("kind"), F.lit(key).cast("string").alias("commit_key"),
            *[F.lit(value).cast("long").alias(name) for name, value in known.items()],
            F.current_timestamp().alias("committed_at"),
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/commits"))

    @staticmethod
    def _next_batch(last: Row | None, kind: str) -> str:
        return f"{(last.commit_id if last else 0) + 1:08d}-{kind}"

    def _batches(self, bases: tuple[str, ...], kinds: tuple[str, ...]) -> list[str]:
        visible: list[str] = []
        for c in self.commits():
            if c.kind in bases:
                visible = [c.batch]
            elif c.kind in kinds:
                visible.append(c.batch)
        return visible

    def _read(self, table: str, schema: str, batches: list[str]) -> DataFrame:
        if not batches:
            return _empty(self.spark, schema)
        root = f"{self.path}/{table}"
        return (self.spark.read.schema(schema).option("basePath", root)
                    .parquet(*[f"{root}/batch={b}" for b in batches]))

    # ---- tables --------------------------------------------------------------------

    def transitions(self, max_order: int = MAX_ORDER) -> DataFrame:
        """(ord, state_key, next_token, count); ``max_order`` prunes partitions."""
        batches = self._batches(_COUNT_BASES, ("train",))
        rows = self._read("counts", _COUNTS, batches).where(F.col("ord").between(1, max_order))
        return _summed(rows, len(batches))

    def transitions_with_ids(self, max_order: int = MAX_ORDER) -> DataFrame:
        """(ord, state_key, next_id, count), the next token as its vocabulary id.

        Joined after counting, so each transition meets the vocabulary once. Tokens that follow very many states
        (``</s>``) are measured and joined by broadcast, the rest by shuffle, so no hot token sits in one task even
        without AQE's skew handling.
        """
        ids = self.vocabulary().select(F.col("id").alias("next_id"), F.col("token").alias("next_token"))
        return joined_with_heavy_split(self.transitions(max_order), ids, "next_token").select(
            "ord", "state_key", "next_id", "count")

    def vocabulary(self) -> DataFrame:
        """(id, token, freq)."""
        batches = self._batches(_VOCABULARY_BASES, ("train",))
        rows = self._read("vocabulary", _VOCABULARY, batches)
        if len(batches) == 1:
            return rows.select("id", "token", "freq")
        return rows.groupBy("token").agg(F.max("id").alias("id"), F.sum("freq").alias("freq")).select(
            "id", "token", "freq")

    def documents(self) -> DataFrame:
        return self._read("documents", _DOCUMENTS, self._batches((), ("train",))).drop("batch")

    def training_runs(self) -> DataFrame:
        return self._read("training_runs", _RUNS, self._batches((), ("train",))).drop("batch")

    # ---- walks ---------------------------------------------------------------------

    def record(self, runs: DataFrame, steps: DataFrame) -> str:
        """Append walks to the model's log under ids that go on from the last; returns the batch.

        ``runs`` and ``steps`` are those of :class:`~gramloom.plans.walk.Walks`, with run_id unique among these walks.
        """
        commits = self.commits()
        last = commits[-1] if commits else None
        base = last.last_generation_id or 0 if last else 0
        batch = self._next_batch(last, "generate")
        dense_ids(runs, "run_id", "id", base).select(
            "id", "run_id", "seed", "requested_order", "max_tokens", F.current_timestamp().alias("created_at")
        ).write.mode("overwrite").parquet(f"{self.path}/generation_runs/batch={batch}")
        named = self._read("generation_runs", _GENERATIONS, [batch])
        found = named.agg(F.count("*").alias("n"), F.countDistinct("run_id").alias("distinct")).first()
        if found["n"] != found["distinct"]:
            raise ValueError("run_id is not unique among these walks")
        steps.join(named.select("id", "run_id"), "run_id").select(
            "id", "run_id", "step", "state_key", "order_used", "next_token", "chosen_prob", "n_candidates"
        ).write.mode("overwrite").parquet(f"{self.path}/generation_steps/batch={batch}")
        self._commit(last, batch, "generate", None, last_generation_id=base + found["n"])
        return batch

    def generation_runs(self) -> DataFrame:
        return self._read("generation_runs", _GENERATIONS, self._batches((), ("generate",))).drop("batch")

    def generation_steps(self) -> DataFrame:
        """The log of all walks recorded; ``id`` is the walk's."""
        return self._read("generation_steps", _STEPS, self._batches((), ("generate",))).drop("batch")

    # ---- training ------------------------------------------------------------------

    def train(self, corpus: DataFrame, k: int, force: bool = False, key: str | None = None,
              owner: str | None = None) -> TrainReport:
        """Add a corpus of (source_id, content) at all orders 1..k.

        Sources the model has are refused unless ``force`` is set; when nothing else is
        left, :class:`AlreadyTrained` is raised. ``key`` makes the call idempotent: when a
        commit with that key exists, nothing is done. Sources that came by keys of the form
        ``owner:…`` are not refused, so that one stream may bring a source in several batches.
        """
        if not 1 <= k <= MAX_ORDER:
            raise ValueError(f"order must be 1..{MAX_ORDER}")
        commits = self.commits()
        last = commits[-1] if commits else None
        nobody = _empty(self.spark, "name string")
        if key is not None and any(c.commit_key == key for c in commits):
            return TrainReport(None, nobody)

        corpus = corpus.withColumn("source_id", F.coalesce("source_id", F.lit("")))
        refused = nobody
        if last and not force:
            refused, corpus = self._without_known(corpus, [
                c.batch for c in commits if c.kind == "train" and not (owner and (c.commit_key or "").startswith(f"{owner}:"))])

        batch = self._next_batch(last, "train")
        with tidy(self.spark):
            return self._train(corpus, k, key, batch, last, refused)

    def _train(self, corpus: DataFrame, k: int, key: str | None, batch: str, last: Row | None, refused: DataFrame) -> TrainReport:
        # The longest n-grams are stored first, then one order after the other, each summed from the one above it. Each
        # task's rows are written in order: neighbours share their beginnings, in the files and in later shuffles of
        # what is read from them. The sort begins with state_key, whose first bytes tell most rows apart, so the writer
        # of the first rows keeps a file open for each ord.
        target, order = f"{self.path}/counts/batch={batch}", ["state_key", "next_token"]
        with open_files(self.spark):
            counted = longest(corpus, k).sortWithinPartitions(*order)
            counted.write.mode("overwrite").options(**_FILES).partitionBy("ord").parquet(target)

        def keep(rows: DataFrame, of_order: int) -> DataFrame:
            rows.drop("ord").sortWithinPartitions(*order).write.mode("overwrite").options(**_FILES).parquet(f"{target}/ord={of_order}")
            return self._read("counts", _COUNTS, [batch]).where(F.col("ord") == of_order).drop("batch")

        counted = self._read("counts", _COUNTS, [batch])
        ledger = ledgers(counted.where(F.col("ord") == GRAMS).select(F.col("state_key").alias("gram"), "n"), k)
        ledger.write.mode("append").options(**_FILES).partitionBy("ord").parquet(target)
        shorter(counted, k, keep)
        _delete(self.spark, f"{target}/ord={GRAMS}")
        counts = self._read("counts", _COUNTS, [batch])
        try:
            documents = self._write_documents(counts, batch, last)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            documents = 0
        if not documents:
            if not refused.isEmpty():
                raise AlreadyTrained("every source is in this model; force=True trains it again")
            raise EmptyCorpus("the corpus holds no records")
        tokens = self._write_vocabulary(counts, batch, last)
        runs = self._write_runs(counts, batch, last, k)
        self._write_sketches(counts, batch)
        self._commit(last, batch, "train", key, last_token_id=tokens,
                     last_document_id=documents, last_run_id=runs)
        return TrainReport(batch, refused)

    def _without_known(self, corpus: DataFrame, batches: list[str]) -> tuple[DataFrame, DataFrame]:
        """Names of the corpus that these batches hold, found once and stored, and the corpus without them.

        The names are sent to the texts, which stay where they are; beyond NAMES_SENT of them Spark chooses the join.
        """
        known = self._read("documents", _DOCUMENTS, batches).select("name")
        folder = fresh_dir(self.spark, "refused")
        corpus.select(F.col("source_id").alias("name")).distinct().join(known, "name", "left_semi").write.parquet(folder)
        refused = self.spark.read.schema("name string").parquet(folder)
        n = refused.count()
        if not n:
            return refused, corpus
        names = F.broadcast(refused) if n <= NAMES_SENT else refused
        return refused, corpus.join(names, corpus.source_id == names.name, "left_anti")

    def _write_documents(self, counts: DataFrame, batch: str, last: Row | None) -> int:
        base = last.last_document_id if last else 0
        sources = counts.where(F.col("ord") == LEDGER).select(
            F.col("state_key").alias("name"), F.col("n").alias("token_count"))
        rows = dense_ids(sources, "name", "id", base).select(
            "id", "name", F.current_timestamp().alias("added_at"), "token_count")
        target = f"{self.path}/documents/batch={batch}"
        rows.write.mode("overwrite").parquet(target)
        added = self._read("documents", _DOCUMENTS, [batch]).count()
        return base + added if added else 0

    def _write_vocabulary(self, counts: DataFrame, batch: str, last: Row | None) -> int:
        base = last.last_token_id if last else 0
        tokens = counts.where(F.col("ord") == VOCABULARY).select(
            F.col("next_token").alias("token"), F.col("n").alias("freq"))
        known = self.vocabulary().select("token")
        if last:
            fresh = dense_ids(tokens.select("token").join(known, "token", "left_anti"), "token", "id", base)
            rows = tokens.join(fresh, "token", "left")
        else:
            rows = dense_ids(tokens, "token", "id", base)
        rows.select("id", "token", "freq").write.mode("overwrite").parquet(
            f"{self.path}/vocabulary/batch={batch}")
        return base + self._read("vocabulary", _VOCABULARY, [batch]).where("id IS NOT NULL").count()

    def _write_runs(self, counts: DataFrame, batch: str, last: Row | None, k: int) -> int:
        run_base = last.last_run_id if last else 0
        document_base = last.last_document_id if last else 0
        documents = self._read("documents", _DOCUMENTS, [batch]).select("id", "name")
        per_order = counts.where(F.col("ord").between(GRAMS + 1, LEDGER - 1)).select(
            F.col("state_key").alias("name"), (F.lit(LEDGER) - F.col("ord")).cast("tinyint").alias("ord"),
            F.col("n").alias("ngrams_added"))
        rows = per_order.join(documents, "name").select(
            ((F.col("id") - document_base - 1) * k + F.col("ord") + run_base).alias("id"),
            F.col("id").alias("document_id"), "ord", "ngrams_added", F.current_timestamp().alias("ran_at"))
        rows.write.mode("overwrite").parquet(f"{self.path}/training_runs/batch={batch}")
        return run_base + self._read("training_runs", _RUNS, [batch]).count()

    # ---- maintenance ---------------------------------------------------------------

    def prune(self, min_count: int) -> DataFrame:
        """Keep transitions seen at least ``min_count`` times; ledgers and vocabulary stay. Returns the report per order.

        Works on the merged counts: rare rows of one batch may be frequent in the sum. The report is
        :func:`~gramloom.plans.stats.order_summary` of the pruned model, read from what was written.
        """
        from gramloom.plans.stats import order_summary  # stats builds on this module

        if min_count < 2:
            raise ValueError("min_count must be at least 2")
        batches = self._batches(_COUNT_BASES, ("train",))
        self._snapshot("prune", batches, min_count=min_count)
        return order_summary(self.transitions())

    def compact(self) -> None:
        """Fold all visible batches into one that readers need not merge."""
        self._snapshot("compact", self._batches(_COUNT_BASES, ("train",)), self.vocabulary())

    def rebuild(self) -> None:
        """Undo pruning: merge the counts of every training batch again (from the last folded history on)."""
        self._snapshot("rebuild", self._batches(("history",), ("train",)))

    def _write_sketches(self, counts: DataFrame, batch: str) -> None:
        """HyperLogLog sketches of the batch's distinct states and transitions per order: a few KB, mergeable.

        They take 64-bit hashes, which cost less than strings; so they are not named as the earlier ones of strings were.
        """
        rows = counts.where(F.col("ord") >= 1)
        rows.groupBy("ord").agg(
            F.hll_sketch_agg(F.xxhash64("state_key"), SKETCH_BITS).alias("states"),
            F.hll_sketch_agg(F.xxhash64("state_key", "next_token"), SKETCH_BITS).alias("transitions"),
        ).write.mode("overwrite").parquet(f"{self.path}/{SKETCHES}/batch={batch}")

    def approximate_size(self) -> DataFrame:
        """(ord, transitions, states) estimated by uniting the sketches of the visible batches; no count is read.

        The relative standard error is about 1.04 / sqrt(2^SKETCH_BITS), 1.6 %. Batches written before sketches
        existed are sketched from their counts when read.
        """
        batches = self._batches(_COUNT_BASES, ("train",))
        parts = []
        for b in batches:
            try:
                parts.append(self.spark.read.schema(_SKETCHES).parquet(f"{self.path}/{SKETCHES}/batch={b}"))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._write_sketches(self._read("counts", _COUNTS, [b]), b)
                parts.append(self.spark.read.schema(_SKETCHES).parquet(f"{self.path}/{SKETCHES}/batch={b}"))
        if not parts:
            return _empty(self.spark, "ord tinyint, transitions long, states long")
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        return every.groupBy("ord").agg(
            F.hll_sketch_estimate(F.hll_union_agg("transitions", True)).alias("transitions"),
            F.hll_sketch_estimate(F.hll_union_agg("states", True)).alias("states"))

    def vacuum(self) -> dict[str, int]:
        """Reclaim space: fold the training history, delete what no reader needs, fold the commit rows.

        The unpruned sum of all training counts becomes one ``history`` snapshot (what :meth:`rebuild` starts from),
        so the counts of the training batches before it can go; so can snapshots that a later prune, compact or
        rebuild replaced, and vocabulary batches before the last compaction. Ledgers (documents, runs, walks) stay.
        Commit rows are rewritten as one file. Returns the number of folders and files deleted.
        """
        commits = self.commits()
        if not commits:
            return {"folders": 0, "commit_files": 0}
        history = self._batches(("history",), ("train",))
        if history and (len(history) > 1 or not history[0].endswith("-history")):
            self._snapshot("history", history)
        commits = self.commits()
        keep = set(self._batches(_COUNT_BASES, ("train",))) | set(self._batches(("history",), ("train",)))
        gone = [f"{self.path}/{table}/batch={c.batch}" for c in commits for table in ("counts", SKETCHES)
                if c.batch not in keep and c.kind in ("train",) + _COUNT_BASES + ("history",)]
        words = set(self._batches(_VOCABULARY_BASES, ("train",)))
        gone += [f"{self.path}/vocabulary/batch={c.batch}" for c in commits if c.kind in ("train", "compact") and c.batch not in words]
        folders = sum(_delete(self.spark, path) for path in gone)
        return {"folders": folders, "commit_files": self._fold_commits()}

    def _fold_commits(self) -> int:
        """Write all commit rows as one file, then delete the files they came from."""
        folder = f"{self.path}/commits"
        old = [f for f in _files(self.spark, folder) if f.endswith(".parquet")]
        if len(old) <= 1:
            return 0
        rows = self.spark.read.schema(_COMMITS).parquet(folder)
        snapshot = fresh_dir(self.spark, "commits")
        rows.dropDuplicates(["commit_id"]).coalesce(1).write.parquet(snapshot)  # commit rows: one a call, few
        self.spark.read.schema(_COMMITS).parquet(snapshot).coalesce(1).write.mode("append").parquet(folder)
        for f in old:
            _delete(self.spark, f)
        _delete(self.spark, snapshot)
        return len(old)

    def _snapshot(self, kind: str, batches: list[str], vocabulary: DataFrame | None = None, min_count: int = 1) -> None:
        """Write the sum of these batches' counts as one, clustered: ranges of state_key a file, sorted, so lookups skip
        files and row groups.

        The rows are shuffled once: dealt by ranges of state_key, equal ones lie in one task, where they are summed. A
        batch holds a key once, so a task gets a key as often as there are batches.
        """
        commits = self.commits()
        if not commits:
            raise ValueError("the model is empty")
        batch = self._next_batch(commits[-1], kind)
        target = f"{self.path}/counts/batch={batch}"
        rows = self._read("counts", _COUNTS, batches).where(F.col("ord") >= 1).select("ord", "state_key", "next_token", "n")
        clustered = _summed(rows.repartitionByRange("state_key"), len(batches)).withColumnRenamed("count", "n").where(
            F.col("n") >= min_count).sortWithinPartitions("state_key", "next_token")
        with tidy(self.spark), open_files(self.spark):
            clustered.write.mode("overwrite").options(**_FILES).partitionBy("ord").parquet(target)
            self._write_sketches(self._read("counts", _COUNTS, [batch]), batch)
            if vocabulary is not None:
                vocabulary.write.mode("overwrite").parquet(f"{self.path}/vocabulary/batch={batch}")
        self._commit(commits[-1], batch, kind, None)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _files(spark: SparkSession, folder: str) -> list[str]:
    fs, target = _filesystem(spark, folder)
    if not fs.exists(target):
        return []
    return [str(f.getPath().toString()) for f in fs.listStatus(target) if f.isFile()]


def _delete(spark: SparkSession, path: str) -> int:
    fs, target = _filesystem(spark, path)
    return int(bool(fs.delete(target, True)))


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])


def _summed(rows: DataFrame, batches: int) -> DataFrame:
    if batches == 1:  # one batch holds each key once
        return rows.select("ord", "state_key", "next_token", F.col("n").alias("count"))
    return rows.groupBy("ord", "state_key", "next_token").agg(F.sum("n").alias("count"))
