"""Byte-level BPE by merge ranks: a queue of ranks over the pairs of each pre-token.

A pre-token is a linked list of parts, at first its bytes. Every pair of neighbours whose joined bytes have a rank
waits in the bucket of that rank. A bitmap of three levels says which buckets hold anything, so that finding the
lowest rank takes three find-first-set steps, however long the pre-token is; a bucket gives its leftmost pair first.
Entries of pairs that have changed since are skipped. That is the order of merges of the plain rule (lowest rank, then
leftmost), in n log n steps instead of the square of n.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.bpe import PLAIN, piece_starts
from feedweave.llm.text import chunks

CHUNK_CHARS = 1 << 18
BITS = 6  # of a rank, for each level of the bitmap
MASK = (1 << BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes to rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Merges of one pre-token at a time; all buckets are empty between two."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        most = max(ranks.values()) + 1
        self.buckets: list[list[int]] = [[] for _ in range(most)]
        self.low = [0] * ((most >> 2 * BITS) + 1 << BITS)
        self.mid = [0] * ((most >> 2 * BITS) + 1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token. One that is a token as a whole is that token, whether merges lead there or not."""
        rank_of, buckets, low, mid, top = self.ranks.get, self.buckets, self.low, self.mid, 0
        rank = rank_of(piece)
        if rank is not None:
            return [rank]
        n = len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        held: list[int | None] = [None] * (n + 1)  # the rank of the pair that begins here now
        fresh = range(n - 1)  # places whose pair is new
        while True:
            for i in fresh:
                rank = held[i] = rank_of(piece[i : after[after[i]]])
                if rank is None:
                    continue
                bucket = buckets[rank]
                if bucket:
                    heappush(bucket, i)
                else:
                    bucket.append(i)
                    word = rank >> BITS
                    if not low[word]:
                        mid[word >> BITS] |= 1 << (word & MASK)
                        top |= 1 << (word >> BITS)
                    low[word] |= 1 << (rank & MASK)
            if not top:
                break
            # The lowest rank that any pair has, and the leftmost of its pairs.
            high = (top & -top).bit_length() - 1
            bits = mid[high]
            word = high << BITS | (bits & -bits).bit_length() - 1
            bits = low[word]
            rank = word << BITS | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                low[word] = bits & bits - 1
                if not low[word]:
                    mid[high] &= mid[high] - 1
                    if not mid[high]:
                        top &= top - 1
            if held[i] != rank:
                fresh = ()
                continue
            j = after[i]
            end = after[i] = after[j]
            held[j] = None
            before[end] = i
            left = before[i]
            if end < n:
                fresh = (i, left) if left >= 0 else (i,)
            else:
                held[i] = None
                fresh = (left,) if left >= 0 else ()
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            end = after[i]
            ids.append(ranks[piece[i:end]])
            i = end
        return ids


class _Known(dict):
    """Ids of the pre-tokens met, as bytes of little-endian 32-bit integers; bounded, for short pre-tokens only."""

    def __init__(self, queue: RankQueue, most: int, longest: int):
        self.queue, self.most, self.longest = queue, most, longest

    def __missing__(self, piece: str) -> bytes:
        ids = self.queue.merge(piece.encode())
        ids = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Texts to ids and back by one vocabulary; ``most`` and ``longest`` bound what is remembered, not what is encoded."""

    def __init__(self, path: str, pattern: str, most: int = 600_000, longest: int = 48):
        import regex

        self.pattern, self.ranks = pattern, read_ranks(path)
        self.find = regex.compile(pattern).findall
        self.known = _Known(RankQueue(self.ranks), most, longest)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.plain = pattern == _default_pattern()

    def _pieces(self, texts: list[str]) -> list[list[str]]:
        """Pre-tokens of every text: cut by numpy if the pattern is the public one and all characters are in its table."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        if not self.plain or not len(points) or points.max() >= PLAIN:
            return [self.find(x) for x in texts]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        starts = piece_starts(points, bounds)
        at = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)])]
        first = np.searchsorted(starts, bounds).tolist()
        return [pieces[a:b] for a, b in zip(first, first[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For every text its ids, little-endian unsigned 32-bit integers in a row."""
        known = self.known
        return [b"".join([known[p] for p in pieces]) for pieces in self._pieces(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The worker's codec for a file of ranks; without one the public 50k vocabulary and its pattern."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    key = str(Path(path)), pattern or _default_pattern()
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``id_col, ids``: the ids of every whole text, row by row where the rows lie.

    A null or empty text has no ids. Rows are independent of each other, so repeated rows and ids and null ids come
    out as they are; an empty table gives an empty one; other columns are left out. No special tokens are known:
    their strings are ordinary text. A vocabulary must hold all single bytes that occur.
    """

    def run(batches):
        tool = codec(vocabulary, pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
            for a, b in chunks(bounds, CHUNK_CHARS):
                found = tool.encode(texts[a:b])
                ends = np.cumsum([0, *map(len, found)]) // 4
                ids = np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))],
                    names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def _rows_of(column: pa.ListArray) -> tuple[np.ndarray, list[int]]:
    """All ids of a column in a row, and where each row's begin; null is empty."""
    column = column.fill_null([]) if column.null_count else column
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype("<u4")
    return flat, (ends - ends[0]).tolist()


def decode(rows: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """``id_col, bytes``: what the ids of every row stand for; null ids are none. An id outside the vocabulary is an error."""

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            flat, ends = _rows_of(batch.column(1))
            found = [tool.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=[id_col, "bytes"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, bytes binary")


def digests(rows: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of encoded rows: the ids as little-endian unsigned 32-bit
    integers, and the bytes they decode to."""

    def run(batches):
        tool = codec(vocabulary)
        for batch in batches:
            flat, ends = _rows_of(batch.column(1))
            parts = [flat[a:b] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in parts], pa.int64()),
                 pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in parts], pa.string()),
                 pa.array([hashlib.sha256(tool.decode(x)).hexdigest() for x in parts], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "ids").mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
