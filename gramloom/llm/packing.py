"""Packing of token pieces into sequences by the dot-product heuristic of vector bin packing.

A piece has a demand in three dimensions: tokens, one segment, and loss-bearing tokens; a sequence has a limit in
each. Demands and what is left of a sequence are scaled by the limits, and a sequence is filled by taking, again and
again, the piece that fits in every dimension and has the largest dot product of its demand with what is left (ties:
more tokens, then the smaller key); when none fits, the next sequence opens (Panigrahy and others, "Heuristics for
vector bin packing", 2011).

Documents are cut first: every full window of ``TOKENS`` ids is a sequence of its own, and only the rest of each
document is packed. The rests are dealt by hash of their key into groups of about ``GROUP`` pieces, which are
packed independently in parallel tasks; a group's work is quadratic in its size and bounded, whatever the data.

Texts are tokenised with the ``tokenizers`` library (strings of special tokens count as text) from a JSON file, or
with tiktoken from a rank file of the same vocabulary and pre-tokenising pattern, which gives the same ids some four
times faster (tests hold the two against each other); id 1 closes every document. A null text is empty and yields the piece [1]; rows
with repeated or null doc_id are documents of their own; an empty table gives no rows. A piece's ``ids_crc32`` is the unsigned crc32 of its ids as
little-endian unsigned 32-bit integers. Sequences hold at most ``TOKENS`` ids; padding (not returned) fills a sequence
up to ``TOKENS`` unless its length is a power of two.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.session import fresh_dir

TOKENS = 2048  # ids of a sequence
SEGMENTS = 64  # pieces of a sequence
LOSS = 2048  # loss-bearing ids of a sequence
GROUP = 4096  # rests packed together in one task
END = 1  # the id that closes a document
CHUNK = 256  # texts tokenised at once in a task

PIECES = "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece int"

_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    """A function from texts to lists of ids: tiktoken over a rank file, or the tokenizers library over a JSON file."""
    if path not in _tokenizers:
        if path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            from gramloom.llm.bpe import load_ranks
            made = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
            _tokenizers[path] = lambda texts: made.encode_ordinary_batch(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer
            made = Tokenizer.from_file(path)
            made.encode_special_tokens = True
            _tokenizers[path] = lambda texts: [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]
    return _tokenizers[path]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut(ids: np.ndarray, tokens: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc) of the full windows of a document's ids, then of the rest."""
    for start in range(0, len(ids), tokens):
        piece = ids[start:start + tokens]
        yield start, len(piece), crc(piece)


def pieces(rows: DataFrame, path: str, tokens: int = TOKENS) -> DataFrame:
    """Rows (key, doc_id, text) as their pieces: one row each, ``piece`` numbering them within the document."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _tokenizer(path)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.iloc[at:at + CHUNK]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                out = []
                for key, doc_id, e in zip(part["key"], part["doc_id"], coder(texts)):
                    ids = np.append(np.asarray(e, dtype=np.int64), END)
                    for n, (start, length, c) in enumerate(cut(ids, tokens)):
                        out.append((key, doc_id, start, length, c, len(ids), n))
                yield pd.DataFrame(out, columns=["key", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"]).astype(
                    {"key": "int64", "doc_id": "Int64", "start": "int64", "length": "int64", "ids_crc32": "int64", "doc_tokens": "int64", "piece": "int32"})

    return rows.mapInPandas(work, PIECES)


def dot_product_bins(demand: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The sequence number of every item; ``demand`` is items by dimensions, ordered by preference on ties."""
    scaled = demand / limits
    left = np.arange(len(demand))
    bins = np.empty(len(demand), dtype=np.int64)
    number = 0
    while len(left):
        room = np.ones(len(limits))
        while len(left):
            fits = np.all(scaled[left] <= room + 1e-12, axis=1)
            if not fits.any():
                break
            score = np.where(fits, scaled[left] @ room, -1.0)
            at = int(np.argmax(score))  # the first of equal scores: preference order
            room = room - scaled[left[at]]
            bins[left[at]] = number
            left = np.delete(left, at)
        number += 1
    return bins


def pack(items: DataFrame, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), group: int = GROUP) -> DataFrame:
    """(uid, sequence_id, offset) of items (uid, length, loss) packed under the limits of (tokens, segments, loss).

    ``sequence_id`` is twice the smallest uid of the sequence plus one; offsets run gapless from 0 in the order of
    placement. Every item must fit an empty sequence.
    """
    groups = max(1, math.ceil(items.count() / group))
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    bounds = np.array(limits, dtype=np.float64)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "uid"], ascending=[False, True]).reset_index(drop=True)
        demand = np.stack([frame["length"].to_numpy(np.float64), np.ones(len(frame)), frame["loss"].to_numpy(np.float64)], axis=1)
        frame["bin"] = dot_product_bins(demand, bounds)
        placed = frame.reset_index().sort_values(["bin", "index"])
        placed["offset"] = placed.groupby("bin")["length"].cumsum() - placed["length"]
        placed["sequence_id"] = 2 * placed.groupby("bin")["uid"].transform("min") + 1
        return placed[["uid", "sequence_id", "offset"]]

    return dealt.groupBy("grp").applyInPandas(one, "uid long, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str, spark: SparkSession | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row of ``docs``."""
    spark = spark or docs.sparkSession
    folder = fresh_dir(spark, "packing")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    cut_rows = pieces(rows, path).withColumn("uid", F.monotonically_increasing_id())
    cut_rows.write.parquet(f"{folder}/pieces")  # keys and uids fixed once
    stored = spark.read.parquet(f"{folder}/pieces")
    whole = stored.where(F.col("length") == TOKENS).select("*", (2 * F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = stored.where(F.col("length") < TOKENS)
    placed = pack(rests.select("uid", "length", F.col("length").alias("loss")))
    placed.write.parquet(f"{folder}/placed")
    rests = rests.join(spark.read.parquet(f"{folder}/placed"), "uid")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return whole.select(*columns).unionByName(rests.select(*columns))
