import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gramloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs):
    """Each id of each row in exactly one piece, crc of each piece, sequences within limits and gapless."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text in docs:
        want = ids_of(text)
        got = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in got) == len(want) and got[0].start == 0
        for a, b in zip(got, got[1:]):
            assert a.start + a.length == b.start
        for r in got:
            assert r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.asarray(want[r.start:r.start + r.length], dtype="<u4").tobytes())
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert seq[0].offset == 0 and sum(r.length for r in seq) <= 2048 and len(seq) <= packing.SEGMENTS
        for a, b in zip(seq, seq[1:]):
            assert a.offset + a.length == b.offset
    return by_seq


def test_pieces_and_sequences(spark, documents, prose, awkward):
    docs = [(i, prose(i, (i * 37) % 900)) for i in range(1, 300)] + [(1000 + k, t) for k, (_, t) in enumerate(awkward)]
    docs += [(2000, "<|endoftext|> is text here"), (2001, "x" * 9000)]
    rows = packing.packed_documents(documents(*docs), PATH, spark).collect()
    assert len(rows) == len({(r.doc_id, r.start) for r in rows})
    by_seq = check(rows, docs)
    used = sum(r.length for r in rows)
    assert len(by_seq) <= -(-used // 2048) * 1.1 + 1  # little padding: near the lower bound


def test_repeated_ids_and_null_texts(spark, documents):
    rows = packing.packed_documents(documents((7, "same text"), (7, "same text"), (8, None), (None, "x")), PATH, spark).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 2), (7, 3), (7, 3), (8, 1)]
    assert len({r.sequence_id for r in rows}) == 1


def test_dot_product_respects_every_limit():
    demand = np.array([[10, 1, 0], [10, 1, 10], [5, 1, 5], [20, 1, 20], [1, 1, 1]], dtype=float)
    bins = packing.dot_product_bins(demand, np.array([20, 2, 20.0]))
    for b in set(bins):
        assert (demand[bins == b].sum(axis=0) <= [20, 2, 20]).all()


def test_empty_table(spark, documents):
    assert packing.packed_documents(documents(), PATH, spark).count() == 0


def test_rank_file_gives_the_ids_of_the_json_file(prose):
    import random
    draw = random.Random(9)
    texts = [prose(i, draw.randint(0, 300)) for i in range(300)]
    texts += ["".join(draw.choice("aàbé \n\t\r.,19漢😀the'sIN<|endoftext|>  ") for _ in range(draw.randint(0, 120))) for _ in range(3000)]
    texts += ["", " " * 50, "\n\n \n", "a" * 30_000, "x\x00y", "<|endoftext|>"]
    assert packing._tokenizer(RANKS)(texts) == packing._tokenizer(PATH)(texts)


def test_query_file_packs_as_the_json_file(spark, documents, prose):
    docs = [(i, prose(i, (i * 53) % 700)) for i in range(60)]
    a = sorted(tuple(r)[:5] for r in packing.packed_documents(documents(*docs), PATH, spark).collect())
    b = sorted(tuple(r)[:5] for r in packing.packed_documents(documents(*docs), RANKS, spark).collect())
    assert a == b
