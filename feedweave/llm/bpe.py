"""Byte-level BPE ids of many texts: pieces are found with numpy and encoded once by the tokenizers library.

Byte-level BPE never merges across the pieces of its pre-tokeniser, so the ids of a text are those of its
pieces in a row. Pieces repeat; each worker keeps the ids of those it has met (a bounded table) and hands
only new ones to the library. Texts with characters outside the table below go to the library whole, and so do
those that hold an added token of the file, which the library looks for before it cuts pieces.
"""

from __future__ import annotations

import os
import unicodedata
from pathlib import Path

import numpy as np

from feedweave.llm.text import Powers, chunks, mix

# Code points below this have had their general category for so long that all Unicode versions agree.
PLAIN = 0x0530
SPACE, LETTER, NUMBER, OTHER = range(4)
CHUNK_CHARS = 1 << 19
END = 0


def _classes() -> np.ndarray:
    kind = np.full(PLAIN, OTHER, dtype=np.uint8)
    for c in range(PLAIN):
        general = unicodedata.category(chr(c))[0]
        if general in "LN":
            kind[c] = LETTER if general == "L" else NUMBER
    kind[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    return kind


_CLASS = _classes()
_VALUES = mix(np.arange(1, PLAIN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def piece_starts(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces begin: contractions, runs of letters, numbers, others with one space before, white space."""
    n = len(text)
    kind = _CLASS[text]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True
    begins = np.ones(n + 4, dtype=bool)
    begins[1:n] = (kind[1:] != kind[:-1]) | first[1:n]
    # The last white space before a word stands alone, or joins the word if it is a space.
    word = np.flatnonzero(begins[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:n]) + 1
    begins[word - 1] = True
    begins[word[text[word - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll are pieces where one can begin.
    after = np.zeros(n + 4, dtype=np.uint32)
    after[:n] = text
    mark = np.flatnonzero((text == 0x27) & begins[:n] & ~first[1 : n + 1])
    mark = mark[np.isin(after[mark + 1], [*map(ord, "stmd")])], mark
    begins[mark[0] + 1] = False
    begins[mark[0] + 2] = True
    two = mark[1][~first[np.minimum(mark[1] + 2, n)]]
    pair = after[two + 1] * np.uint32(256) + after[two + 2]
    two = two[np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])]
    begins[two + 1] = False
    begins[two + 3] = True
    return np.flatnonzero(begins[:n])


class Encoder:
    """``encode`` gives the ids of all texts in a row and how many each has."""

    def __init__(self, path: str, most_pieces: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values() if x.content]
        self.most, self.powers = most_pieces, Powers()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.offsets, self.pool = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.int32) for x in found]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        slots = np.arange(len(pieces)) + len(self.offsets) - 1
        lengths = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(pieces))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.pool, np.array(found.ids, dtype=np.int32)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def _plain(self, joined: str, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = piece_starts(text, bounds)
        lengths = np.diff(starts, append=len(text))
        place = np.arange(len(text)) - np.repeat(starts, lengths)
        value = _VALUES[text] * self.powers.upto(int(lengths.max()))[place]
        keys = mix(np.add.reduceat(value, starts))
        distinct, at, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.most:
            self._forget()
        slot = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(slot, len(self.keys) - 1)] == distinct
        if not known.all():
            new = at[~known]
            ends = starts[new] + lengths[new]
            self._learn(distinct[~known], [joined[a:b] for a, b in zip(starts[new].tolist(), ends.tolist())])
            slot = np.searchsorted(self.keys, distinct)
        slot = self.slots[slot][which]
        sizes = self.offsets[slot + 1] - self.offsets[slot]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.offsets[slot] - before[:-1], sizes) + np.arange(before[-1])]
        return ids, np.diff(before[np.searchsorted(starts, bounds)])

    def _some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        text = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        if not len(text):
            return np.zeros(0, np.int32), lengths
        odd = np.unique(np.searchsorted(bounds, np.flatnonzero(text >= PLAIN), side="right") - 1)
        added = [x for x in self.added if x in joined]
        if added:
            odd = np.union1d(odd, [i for i, x in enumerate(texts) if any(a in x for a in added)]).astype(np.int64)
        if not len(odd):
            return self._plain(joined, text, bounds)
        rest = np.setdiff1d(np.arange(len(texts)), odd)
        ids, counts = self._some([texts[i] for i in rest]) if len(rest) else (np.zeros(0, np.int32), lengths[:0])
        whole = dict(zip(odd.tolist(), self._whole([texts[i] for i in odd])))
        parts = dict(zip(rest.tolist(), np.split(ids, np.cumsum(counts)[:-1]) if len(rest) else []))
        every = [whole[i] if i in whole else parts[i] for i in range(len(texts))]
        return np.concatenate(every), np.fromiter(map(len, every), np.int64, len(every))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        texts = [x or "" for x in texts]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        found = [self._some(texts[a:b]) for a, b in chunks(bounds, CHUNK_CHARS)]
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    def encode_ended(self, texts: list[str | None], end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text followed by ``end``."""
        ids, counts = self.encode(texts)
        return np.insert(ids, np.cumsum(counts), end), counts + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file; without a path the public 50k byte-level one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    path = str(Path(path))
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
