"""Line deduplication: exact repeats and lines within a small edit distance, by segment partition.

A line of ``l`` characters is cut into ``distance + 1`` segments. A line within the distance holds one of them
unchanged, near its place; so each line is probed at the lengths and places where that can be, and lines that share
(length, segment, content) are candidates. They are decided by a banded bit-parallel edit distance. The first line of
a class, by document and place, stays; the others go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm import stars
from feedweave.llm.text import Powers, mix
from feedweave.session import fresh_dir, stage

DISTANCE = 2
#: Shorter lines are never removed; lines shorter than the second are removed as exact repeats only.
LEAST_CHARS, LEAST_NEAR = 20, 40
CHUNK_CHARS = 1 << 19
_WORD = (1 << 64) - 1

_UP = Powers()
_DOWN = Powers(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most`` (31 at most), by a 64-bit band along the diagonal."""
    if abs(len(a) - len(b)) > most:
        return False
    head = _common(a, b)
    a, b = a[head:], b[head:]
    tail = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    if not b or len(a) <= most:
        return len(a) <= most
    plus, minus = (_WORD << (63 - most)) & _WORD, 0
    score, row_end = most, 1 << 62
    worst = most + len(b) - (len(a) - most)
    band = 2 * most + 1
    for i, x in enumerate(b):
        # The highest bit stands for the character ``most`` places ahead.
        match, low = 0, i - most
        for j, y in enumerate(a[max(low, 0) : i + most + 1], max(-low, 0)):
            if x == y:
                match |= 1 << (64 - band + j)
        flat = ((((match & plus) + plus) ^ plus) | match | minus) & _WORD
        rise = (minus | ~(flat | plus)) & _WORD
        fall = flat & plus
        if i < len(a) - most:
            score += not flat >> 63
        else:
            score += bool(rise & row_end)
            score -= bool(fall & row_end)
            row_end >>= 1
        if score > worst:
            return False
        plus = (fall | ~((flat >> 1) | rise)) & _WORD
        minus = (flat >> 1) & rise
    return score <= most


def _spans(text: np.ndarray, bounds: np.ndarray):
    """Lines of many texts: text number, line number in it, start and end without white space around."""
    breaks = np.flatnonzero(text == 0x0A)
    starts = np.concatenate([bounds[:-1], breaks + 1])
    # A text starts a line, and so does every line break, also the last one of a text.
    doc = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, side="right") - 1])
    order = np.lexsort((starts, doc))
    doc, starts = doc[order], starts[order]
    ends = np.append(starts[1:] - 1, 0)
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    ends[last] = bounds[1:][doc[last]]
    number = np.arange(len(doc)) - np.searchsorted(doc, doc)
    solid = np.flatnonzero((text != 0x20) & ((text < 0x09) | (text > 0x0D)))
    if not len(solid):
        return doc, number, starts, starts
    left = np.searchsorted(solid, starts)
    right = np.searchsorted(solid, ends)
    some = right > left
    begin = np.where(some, solid[np.minimum(left, len(solid) - 1)], starts)
    end = np.where(some, solid[np.maximum(right - 1, 0)] + 1, starts)
    return doc, number, begin, end


class _Prefix:
    """Hashes of any stretch of a run of code points in constant time."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.down = _DOWN.upto(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * _UP.upto(n + 1)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def line_ids(prefix: _Prefix, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """63-bit hash of each line's content."""
    return (prefix.of(start, end) >> np.uint64(1)).astype(np.int64)


def segment(length: np.ndarray, i: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and length of segment ``i`` of a line: the last ones have the odd characters."""
    count = distance + 1
    base, odd = length // count, length % count
    return i * base + np.maximum(i - (count - odd), 0), base + (i >= count - odd)


def segment_keys(prefix: _Prefix, start: np.ndarray, end: np.ndarray, distance: int, least: int):
    """(key, number of the line): contents at every place where a line as long or shorter can have a segment."""
    size = end - start
    keys, owners = [], []
    for shorter in range(distance + 1):
        length = size - shorter
        for i in range(distance + 1):
            place, width = segment(length, i, distance)
            left = np.maximum(np.maximum(place - i, place + shorter - (distance - i)), 0)
            right = np.minimum(np.minimum(place + i, place + shorter + (distance - i)), size - width)
            for step in range(2 * distance + 1):
                at = np.flatnonzero((length >= least) & (left + step <= right))
                if not len(at):
                    break
                begin = start[at] + left[at] + step
                tag = (length[at] * (distance + 1) + i).astype(np.uint64)
                keys.append(mix(prefix.of(begin, begin + width[at]) + mix(tag)))
                owners.append(at)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _code_points(column: pa.Array):
    """Texts as code points, some rows at a time: (first row, last row, code points, bounds)."""
    texts = ["" if x is None else x for x in column.to_pylist()]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first, total = 0, np.concatenate([[0], np.cumsum(sizes)])
    while first < len(texts):
        last = int(np.searchsorted(total, total[first] + CHUNK_CHARS, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        text = np.frombuffer("".join(texts[first:last]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        yield first, last, text, total[first : last + 1] - total[first]
        first = last


def _rows(docs: DataFrame, distance: int, least: int, near: int) -> DataFrame:
    """A note (row, line, place) for every line of ``least`` characters, and the signatures of those of ``near``."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, text, bounds in _code_points(batch.column(1)):
                doc, number, start, end = _spans(text, bounds)
                long = end - start >= least
                doc, number, start, end = doc[long], number[long], start[long], end[long]
                prefix = _Prefix(text)
                line, own = line_ids(prefix, start, end), ids[a:b][doc]
                yield stars.rows_of(mix(own.astype(np.uint64) + number.astype(np.uint64)), own, number, line, stars.NOTE)
                some = np.flatnonzero(end - start >= near)
                some = some[np.unique(line[some], return_index=True)[1]]
                keys, owner = segment_keys(prefix, start[some], end[some], distance, near)
                yield from stars.share_rows(keys, line[some][owner])

    return docs.select("id", "text").mapInArrow(run, stars.ROWS)


def _decide(distance: int):
    def make():
        def items(column):
            texts = column.to_pylist()
            yield 0, len(texts), texts

        return items, lambda own, other: within(own, other, distance)

    return make


def _prepare(content: bytes) -> tuple[str, np.ndarray]:
    """A line and how often it has each of 64 kinds of characters."""
    line = content.decode()
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return line, np.bincount(points & 63, minlength=64).astype(np.int32)


def _links_of(distance: int):
    def links_of(own, held, wanted):
        # An edit changes two counts by one at most.
        change = np.abs(np.stack([x[1] for x in held]) - own[1]).sum(axis=1)
        for i in np.flatnonzero(change <= 2 * distance).tolist():
            if wanted(i) and within(own[0], held[i][0], distance):
                yield i

    return links_of


def repeated_lines(docs: DataFrame, folder: str, distance: int = DISTANCE, least: int = LEAST_CHARS,
                   near: int = LEAST_NEAR) -> DataFrame:
    """``id, place`` of every line that a line of its class comes before; ``docs`` has unique ids and texts."""
    found = stage(stars.meetings(_rows(docs, distance, least, near)), "met", folder)
    notes = found.filter(F.col("kind") == stars.NOTE).select(
        F.col("a").alias("id"), F.col("b").alias("line"), F.col("n").alias("place"))
    met = found.filter(F.col("kind") == stars.SHARE).select("a", "b", "key")
    pairs = stage(met.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.count("*").alias("times")),
                  "pairs", folder)

    # Texts of the candidates, from the first place each is found at.
    ends = pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct()
    firsts = notes.groupBy("line").agg(F.min(F.struct("id", "place")).alias("at"), F.count("*").alias("n"))
    firsts = stage(firsts.select("line", "at.id", "at.place", "n"), "firsts", folder)
    places = (firsts.join(ends, "line", "left_semi").groupBy("id")
              .agg(F.collect_list(F.struct("place", "line")).alias("places")))
    lines = F.split("text", "\n", -1)
    texts = (docs.join(places, "id").withColumn("lines", lines)
             .select(F.explode("places").alias("p"), "lines")
             .select(F.col("p.line").alias("id"),
                     F.regexp_replace(F.element_at("lines", F.col("p.place") + 1), "^[ \t-\r]+|[ \t-\r]+$", "").alias("text")))
    texts = stage(texts, "texts", folder)
    contents = texts.select("id", F.col("text").cast("binary").alias("content"))
    classes = stars.linked_classes(met, pairs, pairs, lambda ids, name: texts.join(ids, "id", "left_semi"), _decide(distance),
                                   lambda ids: contents.join(ids, "id", "left_semi"), _prepare, _links_of(distance), lambda rows: rows, folder)
    classes = stage(classes.select(F.col("id").alias("line"), "component"), "classes", folder)

    # The first line of each class; only lines that have another in their class come further.
    known = firsts.join(classes, "line", "left").withColumn("class", F.coalesce("component", "line"))
    heads = known.filter("component IS NOT NULL").groupBy("class").agg(F.min(F.struct("id", "place")).alias("head"))
    heads = (known.filter("component IS NOT NULL").join(heads, "class").select("line", "head")
             .unionByName(known.filter("component IS NULL AND n > 1").select("line", F.struct("id", "place").alias("head"))))
    return (notes.join(heads, "line").filter((F.col("id") != F.col("head.id")) | (F.col("place") != F.col("head.place")))
            .select("id", "place"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE,
                least: int = LEAST_CHARS, near: int = LEAST_NEAR) -> DataFrame:
    """``docs`` with later repeats of lines cut out of the text, and ``lines_removed``.

    Lines end at a line feed and are compared without the white space around them. Classes are reached by links:
    equal lines of ``least`` characters or more, and lines of ``near`` or more within ``distance`` edits. Of a class the line of the
    smallest id and place stays. What stays of a text is unchanged, so a text without repeats is too. A null text stays
    null, an empty one empty. Ids are unique; rows that share an id are cut alike, rows with a null id are left as they are.
    A column of ``docs`` named ``lines_removed`` is replaced. An empty table gives no rows.
    """
    folder = fresh_dir(docs.sparkSession, "lines")
    bare = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cuts = repeated_lines(bare.filter("id IS NOT NULL AND text IS NOT NULL"), folder, distance, least, near)
    cuts = cuts.groupBy("id").agg(F.array_sort(F.collect_set("place")).alias("_cuts")).withColumnRenamed("id", "_id")
    columns = [c for c in docs.columns if c != "lines_removed"]
    joined = docs.join(cuts, F.col(f"`{id_col}`").cast("long") == F.col("_id"), "left")
    stays = F.filter(F.split(F.col(f"`{text_col}`"), "\n", -1), lambda x, i: ~F.array_contains(F.col("_cuts"), i))
    text = F.when(F.col("_cuts").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(stays, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns],
                         F.coalesce(F.size("_cuts"), F.lit(0)).alias("lines_removed"))
