"""Exact Jaccard self-join of documents' word shingles by prefixes.

All shingles have one order. Two linked sets have at least ``percent`` of the larger one's elements in common, so the
smallest they share comes in each before all but as many: it is among the first ``n - ceil(percent * n / 100) + 1`` of the
``n`` elements of either, and these are the signatures. Any order is exact. The one taken puts shingles last that several
of a sample of documents have, by how many have them, and parts the others by their hash, so that rows seldom meet by what many
texts repeat.

Candidates are gathered and decided as in ``stars``: by their whole sets, without pairing a signature's rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm import stars
from feedweave.llm.prefilter import maybe_in
from feedweave.llm.text import CHUNK_BYTES, WHITE, chunks, mix, shingles, utf8, word_hashes
from feedweave.session import fresh_dir, stage

SHINGLE = 5
PERCENT = 80
#: One document in so many is asked which shingles are common; of those found at most so many are put last.
ASKED, MOST_COMMON = 20, 1 << 20


def differences(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The most elements that linked sets of ``a`` and ``b`` elements can differ in."""
    return (100 - percent) * (a + b) // (100 + percent)


def signatures(sets: np.ndarray, before: np.ndarray, percent: int = PERCENT, common=None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of many sets (sorted elements in a row, ``before`` each set): (signature, number of its set).

    ``common``: sorted elements and how common each is; others come before them.
    """
    sizes = np.diff(before)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if common is not None and len(common[0]):
        at = np.minimum(np.searchsorted(common[0], sets), len(common[0]) - 1)
        often = np.where(common[0][at] == sets, common[1][at], 0)
        sets = sets[np.lexsort((often, owner))]
    place = np.arange(len(sets)) - before[:-1][owner]
    keep = place <= (sizes - (percent * sizes + 99) // 100)[owner]
    return sets[keep], owner[keep]


def sets_of(column: pa.Array):
    """Shingle sets of a column of texts, some rows at a time: (first row, last row, elements, before each set)."""
    data, bounds = utf8(column)
    for a, b in chunks(bounds, CHUNK_BYTES):
        words, before = word_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], WHITE)
        yield a, b, *shingles(words, before, SHINGLE)


def sketch(elements: np.ndarray, spread: int = 1) -> bytes:
    """Parity of the number of elements in each of a power of two of cells, ``spread`` an element or more.

    Two sketches differ in at most as many bits as their sets differ in elements.
    """
    cells = spread * max(64, 1 << max(len(elements) - 1, 0).bit_length())
    place = (mix(elements ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Sketches (a row each) of fewer cells: halves are added up."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def may_link(n: int, own: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets can be linked, by size and sketch; ``others`` has a sketch in each row, as long as ``own`` or longer."""
    fits = 100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)
    apart = np.bitwise_count(folded(others, own.shape[0]) ^ own).sum(axis=1)
    return fits & (apart <= differences(n, sizes, percent))


def _content(n: int, elements: np.ndarray, spread: int = 1) -> bytes:
    return int(n).to_bytes(4, "little") + sketch(elements, spread)


def _compare(percent: int):
    def compare(content: bytes, held: list[bytes]) -> list[int]:
        own_n, own = int.from_bytes(content[:4], "little"), np.frombuffer(content, np.uint8)[4:]
        found = []
        by_length: dict[int, list[int]] = {}
        for i, other in enumerate(held):
            by_length.setdefault(len(other) - 4, []).append(i)
        for length, at in by_length.items():
            raw = np.frombuffer(b"".join(held[i] for i in at), np.uint8).reshape(len(at), -1)
            sizes = raw[:, :4].copy().view("<u4").reshape(-1).astype(np.int64)
            mine = own if length >= len(own) else folded(own[None], length)[0]
            found += np.asarray(at)[may_link(own_n, mine, sizes, raw[:, 4:], percent)].tolist()
        return found

    return compare


#: Cells an element of the sketches by which rows of opened keys are compared: four times as many leave few pairs in doubt.
FINE = 4


def _prepare(content: bytes):
    """Size and sketch of a set."""
    return int.from_bytes(content[:4], "little"), np.frombuffer(content, np.uint8)[4:]


def _may_link_of(percent: int):
    def may_link_of(own, held, wanted):
        n, bits = own
        by_length: dict[int, list[int]] = {}
        for i, other in enumerate(held):
            by_length.setdefault(len(other[1]), []).append(i)
        for length, at in by_length.items():
            mine = bits if length >= len(bits) else folded(bits[None], length)[0]
            likely = may_link(n, mine, np.array([held[i][0] for i in at]), np.stack([held[i][1] for i in at]), percent)
            yield from np.asarray(at)[likely].tolist()

    return may_link_of


def _fine_sketches(texts: DataFrame) -> DataFrame:
    """``id, content`` of (id, text): size and fine sketch of each set."""

    def run(batches):
        for batch in batches:
            for a, b, sets, before in sets_of(batch.column(1)):
                content = [_content(before[i + 1] - before[i], sets[before[i] : before[i + 1]], FINE) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(content, pa.binary())], names=["id", "content"])

    return texts.select("id", "text").mapInArrow(run, "id long, content binary")


def _common(docs: DataFrame, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several of a sample of documents have, and how many of it have each."""

    def run(batches):
        for batch in batches:
            for _, _, sets, _ in sets_of(batch.column(0)):
                found, n = np.unique(sets, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])

    asked = docs.filter(F.pmod(F.xxhash64("id"), F.lit(ASKED)) == 0).select("text")
    counts = asked.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = stage(counts, "common", folder)
    least, held = None, 0
    for n, shingles_of in sorted(counts.groupBy("n").count().collect(), reverse=True):
        held += shingles_of
        if held > MOST_COMMON:
            break
        least = n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.filter(F.col("n") >= least).toArrow()
    shingle, n = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(shingle)
    return shingle[order], n[order]


def _signature_rows(docs: DataFrame, percent: int, common) -> DataFrame:
    """A note with the size, hash and sketch of every set, and its signatures; one of equal sets of a few rows stands for all.

    ``common`` is broadcast.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, sets, before in sets_of(batch.column(1)):
                own, n = ids[a:b].astype(np.int64), np.diff(before)
                each = [sets[before[i] : before[i + 1]] for i in range(b - a)]
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets))])
                content = mix(total[before[1:]] - total[before[:-1]] + n.astype(np.uint64))
                yield stars.rows_of(mix(own.astype(np.uint64)), own, n, content.view(np.int64), stars.NOTE,
                                    content=[_content(len(x), x) for x in each])
                chosen = np.sort(np.unique(content, return_index=True)[1])
                chosen = chosen[n[chosen] > 0]
                kept = np.concatenate([sets[:0], *(each[i] for i in chosen)])
                keys, owner = signatures(kept, np.concatenate([[0], np.cumsum(n[chosen])]), percent, common.value)
                owner = chosen[owner]
                yield from stars.share_rows(keys, own[owner])

    return docs.select("id", "text").mapInArrow(run, stars.ROWS)


def _decide(percent: int):
    def make():
        def items(column):
            for a, b, sets, before in sets_of(column):
                yield a, b, [sets[before[i] : before[i + 1]] for i in range(b - a)]

        def linked(own, other):
            both = int(np.isin(own, other, assume_unique=True).sum())
            return 100 * both >= percent * (len(own) + len(other) - both)

        return items, linked

    return make


def _possible(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b, times) whose sizes and sketches allow a link."""
    test = _compare(percent)

    def run(batches):
        for batch in batches:
            one, two = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            keep = [bool(test(x, [y])) for x, y in zip(one, two)]
            yield batch.select(["a", "b", "times"]).filter(pa.array(keep, pa.bool_()))

    of_a = contents.select(F.col("id").alias("a"), F.col("content").alias("one"))
    of_b = contents.select(F.col("id").alias("b"), F.col("content").alias("two"))
    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "times", "one", "two")
    return both.mapInArrow(run, "a long, b long, times long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id, n_shingles, component_id`` of every document: links are pairs of Jaccard ``percent``/100 or more.

    Words are runs of anything but ASCII white space, A-Z lower-cased; sets hold 5-word shingles, or the whole
    sequence of fewer words. A null, empty or blank text has no shingle and no link. Ids are unique; a row
    that repeats an id and its text is one with it, a null id is left out. Other columns are ignored. An
    empty table gives no rows.
    """
    folder = fresh_dir(docs.sparkSession, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.filter("id IS NOT NULL")
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, folder))
    found = stage(stars.meetings(_signature_rows(docs, percent, common)), "met", folder)
    common.destroy()

    # Equal sets: the smallest id stands for the others from here on.
    notes = found.filter(F.col("kind") == stars.NOTE).select(
        F.col("a").alias("id"), F.col("b").alias("hash"), "n", "content").dropDuplicates(["id"])
    lead = notes.filter("n > 0").groupBy("hash", "n").agg(F.min("id").alias("lead"))
    sizes = stage(notes.select("id", "hash", "n").join(lead, ["hash", "n"], "left")
                  .select("id", "n", F.coalesce("lead", "id").alias("lead")), "sizes", folder)
    of_a = sizes.select(F.col("id").alias("a"), F.col("lead").alias("la"))
    of_b = sizes.select(F.col("id").alias("b"), F.col("lead").alias("lb"))
    met = found.filter(F.col("kind") == stars.SHARE).select("a", "b", "key")
    raw = stage(met.groupBy("a", "b").agg(F.count("*").alias("times")), "raw-pairs", folder)
    pairs = raw.join(of_a, "a").join(of_b, "b").filter("la <> lb")
    pairs = stage(pairs.groupBy(F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b"))
                  .agg(F.sum("times").alias("times")), "pairs", folder)
    touched = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    contents = stage(notes.select("id", "content").join(touched, "id", "left_semi"), "sketches", folder)

    def texts_of(ids: DataFrame, name: str) -> DataFrame:
        # Ids come once. A semi-join would be moved in front of the bitmap, and all texts be dealt out.
        return stage(maybe_in(docs, "id", ids).join(ids, "id").dropDuplicates(["id"]), name, folder)

    def sketches_of(ids: DataFrame) -> DataFrame:
        return _fine_sketches(maybe_in(docs, "id", ids)).join(ids, "id", "left_semi").dropDuplicates(["id"])

    classes = stars.linked_classes(
        met, raw, pairs, texts_of, _decide(percent), sketches_of, _prepare, _may_link_of(percent),
        lambda rows: _possible(rows, contents, percent), folder, sizes.select("id", "lead"), exact=False,
        spent=("met", "raw-pairs", "pairs", "sketches", "common", "possible", "texts"))
    classes = classes.select(F.col("id").alias("lead"), "component")
    return sizes.join(classes, "lead", "left").select(
        "id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "lead").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class; rows with a null id are kept."""
    classes = near_classes(docs, id_col, text_col, percent)
    dropped = classes.filter("id <> component_id").select(F.col("id").alias(id_col))
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
