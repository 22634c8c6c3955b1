import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gramloom.llm import bpe

FILE = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(public_tokenizers.path(FILE))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_merge_as_the_library_merges_them(library):
    own, draw = bpe.coder(public_tokenizers.path(FILE)), random.Random(3)
    for _ in range(1500):
        piece = "".join(draw.choice("theinaoustré") for _ in range(draw.randint(1, 60)))
        assert own.encode(piece.encode()) == library.encode_ordinary(piece)


def test_random_texts_and_special_tokens(library):
    own, draw = bpe.encoder(public_tokenizers.path(FILE), public_tokenizers.PATTERN), random.Random(4)
    texts = ["".join(draw.choice("aàbé \n\t.,19漢😀the'sIN<|endoftext|>") for _ in range(draw.randint(0, 80))) for _ in range(800)]
    for text in texts + ["<|endoftext|>", "   x  ", "don't", "  "]:
        assert np.frombuffer(own(text), np.int32).tolist() == library.encode_ordinary(text)


def test_long_pieces_take_linear_time(library):
    own = bpe.coder(public_tokenizers.path(FILE))
    assert len(own.encode(b"a" * 200_000)) > 1000  # quadratic work would not end


def test_columns_round_trip_with_nulls_and_repeats(spark, documents, awkward, library):
    rows = documents(*awkward).select("text", bpe.encode(F.col("text")).alias("ids")).select("text", "ids", bpe.decode(F.col("ids")).alias("back")).collect()
    assert len(rows) == len(awkward)
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()


def test_empty_table(spark, documents):
    assert documents().select(bpe.encode(F.col("text")).alias("ids")).count() == 0


def test_query_matches_the_library(spark, library):
    from gramloom.llm.queries import op10_bpe
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op10_bpe(spark, sf).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_token_table_decodes_batches_as_the_plain_decoder():
    ranks = bpe.load_ranks(public_tokenizers.path(FILE))
    plain, table, draw = bpe.decoder(ranks), bpe.TokenTable(ranks), random.Random(8)
    lists = [None, [], [0], *[[draw.randrange(50256) for _ in range(draw.randint(0, 300))] for _ in range(200)]]
    batch = pa_list(lists)
    assert table.decode(batch).to_pylist() == [plain(x or []) for x in lists]
    assert table.decode(batch.slice(5, 20)).to_pylist() == [plain(x or []) for x in lists[5:25]]


def pa_list(rows):
    import pyarrow as pa
    return pa.array(rows, pa.list_(pa.int32()))
