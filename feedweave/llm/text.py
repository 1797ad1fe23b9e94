"""Words of many texts at once, as 64-bit hashes: numpy over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at a time; a longer single text is handled alone and whole.
CHUNK_BYTES = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

# Everything but ASCII letters, digits and non-ASCII characters parts words.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class Powers:
    """Powers of an odd constant, computed as far as they are asked for."""

    def __init__(self, base: int = 0xD6E8FEB86659FD93):
        self.base, self.table = np.uint64(base), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.table):
            more = np.full(max(n, 2 * len(self.table), 4096), self.base, dtype=np.uint64)
            more[0] = 1
            self.table = np.multiply.accumulate(more)
        return self.table


_POWERS = Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[where[0] : where[-1]], where - where[0]


def chunks(bounds: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes, one row at least."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, bounds: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word after A-Z are lower-cased, and the words before each text.

    ``bounds`` are the offsets of the texts in ``data``; ``parts`` says which bytes part words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    gap = parts[data]
    begins = ~gap
    begins[1:] &= gap[:-1]
    edges = bounds[:-1][bounds[:-1] < n]
    begins[edges] = ~gap[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    value = _BYTE_VALUES[LOWER[data]]
    value[gap] = 0
    place = np.arange(n, dtype=np.int64) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    place[gap] = 0
    place[: starts[0]] = 0
    value *= _POWERS.upto(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, starts)), np.searchsorted(starts, bounds)


def distinct_within(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every group; ``before`` counts the values before each group."""
    group = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((values, group))
    values, group = values[order], group[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
    return values[keep], np.searchsorted(group[keep], np.arange(len(before)))


def shingles(words: np.ndarray, before: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text; a shorter text is one shingle, no word none."""
    lengths = np.diff(before)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(lengths)), counts)
    start = before[:-1][doc] + np.arange(first[-1]) - first[:-1][doc]
    total = np.zeros(first[-1], dtype=np.uint64)
    stop = before[1:][doc]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    factors = mix(np.arange(101, 101 + size, dtype=np.uint64))
    for j in range(size):
        at = start + j
        total += np.where(at < stop, padded[at] * (factors[j] | np.uint64(1)), factors[j])
    return distinct_within(mix(total), first)


def ragged(values: np.ndarray, before: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(values, kind))
