"""Cost-balanced packing of documents into sequences of bounded length.

A document is cut into full sequences and a rest. Rests gather in windows of a fixed number of tokens, so
memory stays bounded; in each window as many sequences are opened as the rests need, and the rests, longest
first, go to the sequence of least cost (linear plus quadratic attention cost of its pieces) that has room.
A rest that fits into none of the cheapest is cut where the cheapest is full. Only the last window of a
partition can leave room, less than one sequence in all. No shuffle: pieces stay where the text was read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.bpe import END, encoder

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "`offset` long, cost double")
TRIES = 16


def piece_cost(length: int, quadratic: float) -> float:
    """Attention cost of a piece in units of one token's linear cost."""
    return length + quadratic * length * length


def pack_rests(lengths: list[int], size: int, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], list[float]]:
    """Assign rests to sequences: (rest, start in it, length, sequence, offset), and the cost of each sequence."""
    count = -(-sum(lengths) // size)
    heap = [(0.0, s) for s in range(count)]
    used, costs, placed = [0] * count, [0.0] * count, []
    waiting = [(-n, i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(waiting)
    while waiting:
        n, rest, start = heapq.heappop(waiting)
        n, passed = -n, []
        while heap and len(passed) < TRIES:
            cost, seq = heapq.heappop(heap)
            passed.append((cost, seq))
            if size - used[seq] >= n:
                break
        else:
            passed.append(passed.pop(0))  # none has room for all of it: cut it at the cheapest
        cost, seq = passed.pop()
        for other in passed:
            heapq.heappush(heap, other)
        part = min(n, size - used[seq])
        placed.append((rest, start, part, seq, used[seq]))
        used[seq] += part
        costs[seq] = cost + piece_cost(part, quadratic)
        if used[seq] < size:
            heapq.heappush(heap, (costs[seq], seq))
        if part < n:
            heapq.heappush(waiting, (part - n, rest, start + part))
    return placed, costs


def pack(docs: DataFrame, size: int = 1024, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, end: int = END, quadratic: float | None = None,
         window_tokens: int = 1 << 21) -> DataFrame:
    """One row for each piece: its document, place in it, ids (little-endian 32-bit) and place in a sequence.

    A null text is empty and gives the end id alone; null ids stay null; rows that share an id are packed
    each for itself; other columns are left out. ``quadratic`` is the cost of a token pair in units of a token's
    linear cost, by default such that both halves of a full sequence's cost are equal. Sequence ids are
    unique over partitions. An empty table gives no pieces.
    """
    pair = 1.0 / size if quadratic is None else quadratic

    def run(batches):
        from pyspark import TaskContext

        tool, sequence = encoder(tokenizer), TaskContext.get().partitionId() << 33
        rests, held = [], 0

        def table(pieces):
            columns = list(zip(*pieces)) or [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"])

        def flush():
            nonlocal rests, held, sequence
            placed, costs = pack_rests([len(r[3]) for r in rests], size, pair)
            out = []
            for rest, start, length, seq, offset in placed:
                doc, total, at, ids = rests[rest]
                out.append((doc, at + start, length, ids[start : start + length].tobytes(), total,
                            sequence + seq, offset, costs[seq]))
            sequence += len(costs)
            rests, held = [], 0
            for a in range(0, len(out), 2000):
                yield table(out[a : a + 2000])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, counts = tool.encode_ended(part.column(1).to_pylist(), end)
                ids, full, first = ids.astype("<i4"), [], 0
                for doc, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    for start in range(0, n - size + 1, size):
                        whole = ids[first + start : first + start + size].tobytes()
                        full.append((doc, start, size, whole, n, sequence, 0, piece_cost(size, pair)))
                        sequence += 1
                    if n % size:
                        start = n - n % size
                        rests.append((doc, n, start, ids[first + start : first + n].copy()))
                        held += n % size
                    first += n
                if full:
                    yield table(full)
                if held >= window_tokens:
                    yield from flush()
        yield from flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)
