"""Byte-level BPE: encoding by longest matches with backtracking, and decoding.

Bytes are mapped to Latin-1 characters, so that one pyahocorasick automaton finds the longest token at
every position in a single pass. From the left, the longest token is taken whose pairing with the token
before it could stand in a merge result; where none fits, the last token is taken back and a shorter one
tried, and positions found to be dead ends are not tried again. A pair can stand if undoing its merges,
latest first, never meets a merge over the boundary that came earlier. Verdicts are memoised, and the work is
linear in the text (Antonov and others, "So many tokens, so little time", 2024).
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

CACHED_PIECES = 150_000  # pieces remembered per worker; when full, the memory is emptied
CACHED_LENGTH = 48
PAIRS = 150_000  # verdicts on adjacent tokens remembered per worker; when full, the memory is emptied


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """Encodes and decodes bytes by merge ranks. Every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.shorter = [-1] * size  # the longest token that begins this one
        for token, rank in ranks.items():
            for n in range(len(token) - 1, 0, -1):
                if (prefix := ranks.get(token[:n])) is not None:
                    self.shorter[rank] = prefix
                    break
        self.left, self.right = list(range(size)), list(range(size))  # the two tokens last merged
        self.merged: dict[tuple[int, int], int] = {}
        self.stands: dict[tuple[int, int], bool] = {}
        for rank in range(size):
            self._find_merge(rank)
        self.length = list(map(len, self.token))
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.matcher.make_automaton()

    def _find_merge(self, rank: int) -> None:
        token, first = self.token[rank], self.shorter[rank]
        while first >= 0:
            second = self.ranks.get(token[len(self.token[first]):])
            if second is not None and first < rank and second < rank and self._can_stand(first, second):
                self.merged[first, second] = rank
                self.left[rank], self.right[rank] = first, second
                return
            first = self.shorter[first]

    def _can_stand(self, a: int, b: int) -> bool:
        """Whether undoing merges around the boundary of a and b, latest first, never meets an earlier one over it."""
        left, right = self.left, self.right
        limit = len(self.token)  # merges over the boundary matter when earlier than the last one undone
        while self.merged.get((a, b), limit) >= limit:
            whole_a, whole_b = right[a] == a, left[b] == b  # nothing to undo
            if whole_a and whole_b:
                return True
            if whole_b or (a > b and not whole_a):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]  # on a tie the left one merges first
        return False

    def encode(self, piece: bytes) -> list[int]:
        """Ids as all merges in order of rank would give them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * (len(piece) + 1)
        for end, (rank, back) in self.matcher.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # later ends are longer
        dead: set[int] = set()
        length, shorter, stands = self.length, self.shorter, self.stands
        out: list[int] = []
        at, rank, last = 0, longest[0], -1
        while rank >= 0:
            end = at + length[rank]
            if end not in dead:
                fits = last < 0
                if not fits:
                    fits = stands.get((last, rank))
                    if fits is None:
                        if len(stands) >= PAIRS:
                            stands.clear()
                        fits = stands[last, rank] = self._can_stand(last, rank)
                if fits:
                    out.append(rank)
                    last, at, rank = rank, end, longest[end]
                    continue
            if shorter[rank] >= 0:
                rank = shorter[rank]
            else:
                dead.add(at)
                rank = out.pop()
                last = out[-1] if out else -1
                at -= length[rank]
        return out


def decoder(ranks: dict[bytes, int]) -> Callable[[Iterable[int]], bytes]:
    """Ids to the bytes that they stand for."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return lambda ids: b"".join(map(tokens.__getitem__, ids))


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One coder per file and Python worker."""
    if path not in _coders:
        _coders[path] = Coder(load_ranks(path))
    return _coders[path]


class Pieces(dict):
    """Ids of pieces as int32 bytes, computed when first asked for. Short pieces are remembered."""

    def __init__(self, own: Coder):
        super().__init__()
        self.own = own

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.own.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


_pieces: dict[str, Pieces] = {}


def encoder(path: str, pattern: str) -> Callable[[str], bytes]:
    """Text to ids (int32 bytes), each match of the pattern on its own."""
    known = _pieces.setdefault(path, Pieces(coder(path)))
    split, ids_of = regex.compile(pattern), known.__getitem__

    def encode(text: str) -> bytes:
        return b"".join(map(ids_of, split.findall(text)))

    return encode


def _ids_array(rows: Iterator[bytes]) -> pa.Array:
    rows = list(rows)
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int64) // 4
    values = np.frombuffer(b"".join(rows), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def encode(text: Column, file: str = "byte_bpe_multi_50k.tiktoken", pattern: str = public_tokenizers.PATTERN) -> Column:
    """Ids (array of int) of each text. Null and empty texts give an empty array; special tokens are plain text.

    ``file`` names one of the public rank files, or is a path that every executor can open.
    """

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(public_tokenizers.path(file), pattern)
        for batch in batches:
            yield _ids_array(own(t.as_py() or "") for t in batch)

    return run.asNondeterministic()(text)


class TokenTable:
    """The bytes of all tokens as one array of objects, so a row's ids are decoded by one take and one join.

    Work and memory follow a row, not a whole Arrow batch: no index of all the batch's bytes is built.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = np.empty(max(ranks.values()) + 1, dtype=object)
        self.tokens[:] = b""
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, lists: pa.Array) -> pa.Array:
        """Binary of each list of ids; a null or empty list gives no bytes."""
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        tokens = self.tokens
        return pa.array([b"".join(tokens[ids[e - n:e]]) for n, e in zip(counts.tolist(), ends.tolist())], pa.binary())


_tables: dict[str, TokenTable] = {}


def decode(ids: Column, file: str = "byte_bpe_multi_50k.tiktoken") -> Column:
    """The bytes (binary) that the ids stand for. A null or empty array gives no bytes."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        path = public_tokenizers.path(file)
        table = _tables.get(path) or _tables.setdefault(path, TokenTable(load_ranks(path)))  # once a worker
        for batch in batches:
            yield table.decode(batch)

    return run.asNondeterministic()(ids)
