"""Sorting the words of many texts by pointers to their starts, with multikey quicksort.

Pointers go into the bytes of an Arrow column. A slice of them is parted three ways by the next eight bytes of the
words (lower, equal, higher); the equal part goes on with the eight bytes after, until the words end. Small parts are
finished by sorting them on the same keys. Every step keeps equal words in the order of their places, so the words of
one text, and the texts of one group, stand together inside a run of equal words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from feedweave.llm.text import LOWER

# ASCII letters and all bytes of other characters are parts of terms.
TERM = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
SMALL = 1 << 14
WIDTH = 8
# The first so many bytes of eight.
LEADING = np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(WIDTH + 1)], dtype=np.uint64)


def term_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term of the texts in ``data``, none across two texts."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1 : n + 1] = TERM[data]
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    starts[edges] |= inside[edges + 1]
    ends[edges - 1] |= inside[edges]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


class TermSort:
    """Order of the terms ``starts[i]:ends[i]`` of ``data``, A-Z as a-z."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.zeros(len(data) + 2 * WIDTH, dtype=np.uint8)
        padded[: len(data)] = LOWER[data]
        self.bytes = padded
        self.words = np.ndarray(len(padded) - WIDTH + 1, dtype=">u8", buffer=padded.data, strides=(1,))
        self.starts, self.ends = starts, ends

    def _keys(self, which: np.ndarray, depth: int) -> np.ndarray:
        """The next eight bytes as a number, zero bytes after the end of the term."""
        at = self.starts[which] + depth
        left = np.clip(self.ends[which] - at, 0, WIDTH)
        return self.words[np.minimum(at, len(self.words) - 1)].astype(np.uint64) & LEADING[left]

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms in ascending order of their bytes, and where each run of equal terms begins in it."""
        out = np.empty(len(self.starts), dtype=np.int64)
        new = np.zeros(len(self.starts), dtype=bool)
        parts = [(0, np.arange(len(self.starts)), 0, None)]
        while parts:
            at, which, depth, keys = parts.pop()
            if not len(which):
                continue
            if keys is None:
                keys = self._keys(which, depth)
            if len(which) <= SMALL:
                which, begins = self._small(which, keys, depth)
                out[at : at + len(which)], new[at : at + len(which)] = which, begins
                continue
            pivot = np.sort(keys[:: max(1, len(keys) // 64)])[len(keys) // max(1, len(keys) // 64) // 2]
            low, high = keys < pivot, keys > pivot
            same = ~(low | high)
            n_low, n_same = int(low.sum()), int(same.sum())
            parts.append((at, which[low], depth, keys[low]))
            parts.append((at + n_low + n_same, which[high], depth, keys[high]))
            equal, place = which[same], at + n_low
            if pivot & np.uint64(0xFF):
                parts.append((place, equal, depth + WIDTH, None))
            else:
                out[place : place + n_same], new[place] = equal, True
        return out, np.flatnonzero(new)

    def _small(self, which: np.ndarray, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        which, keys = which[order], keys[order]
        begins = np.ones(len(which), dtype=bool)
        begins[1:] = keys[1:] != keys[:-1]
        # Words that go on, in runs of equal keys so far: all such runs at once.
        open_ = np.flatnonzero(keys & np.uint64(0xFF))
        while len(open_):
            depth += WIDTH
            run = np.cumsum(begins)[open_]
            more = self._keys(which[open_], depth)
            order = np.lexsort((more, run))
            which[open_], more, run = which[open_][order], more[order], run[order]
            begins[open_[1:]] |= (run[1:] == run[:-1]) & (more[1:] != more[:-1])
            open_ = open_[(more & np.uint64(0xFF)) > 0]
        return which, begins


def slices(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes, one text at least."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield first, last
        first = last
