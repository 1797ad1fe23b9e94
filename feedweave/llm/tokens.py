"""Token files: ORC with run-length encoded ids, row indexes and Bloom filters on document ids.

``write_tokens`` encodes whole texts and writes them in ascending order of document id; ``read_tokens`` reads
the files back, all stripes in parallel or, for given ids, only the stripes and row groups that can hold them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedweave.llm.bpe import END, encoder

SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>"

# Stripes are read in parallel; one row index entry for so many documents lets a look-up skip the others.
OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
            end: int = END) -> DataFrame:
    """Ids of every document with ``end`` after them, in the order and partitions of ``docs``.

    A null text is empty, so its ids are ``end`` alone; a null id stays null; other columns are left out.
    ``shard`` numbers the partition, ``shard_start`` counts the ids before the document in it.
    """

    def run(batches):
        from pyspark import TaskContext

        tool, shard, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, counts = tool.encode_ended(part.column(1).to_pylist(), end)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(np.full(len(counts), shard, np.int32)),
                     pa.array(before + bounds[:-1]), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["doc_id", "shard", "shard_start", "n_tokens", "ids"])
                before += int(bounds[-1])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end: int = END) -> None:
    """Write the ids of all documents, ascending by id over the files as they are named.

    Null ids come first. Rows that share an id are ordered by a hash of their text; rows equal in both
    are interchangeable. An empty table gives files without rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encoded(ordered, tokenizer=tokenizer, end=end).write.options(**OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: the files' rows, with the number of ids in all rows before.

    Given ``ids``, the look-up reaches the files as a pushed-down filter.
    """
    stored = spark.read.schema(SCHEMA).orc(path)
    rows = stored if ids is None else stored.filter(F.col("doc_id").isin(ids))
    return with_start(rows, stored).select("doc_id", "start", "n_tokens", "ids")


def with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` of the files ``stored`` with ``start``, the number of ids in all rows before."""
    # One row for each file: what lies before it.
    shards = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return rows.join(shards, "shard").withColumn("start", F.col("before") + F.col("shard_start"))


def crc32_of_ids(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``ids_crc32``: unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches):
        for batch in batches:
            lists = batch.column(len(keep))
            bounds = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<i4")
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(sums, pa.int64())], names=[*keep, "ids_crc32"])

    return rows.select(*keep, "ids").mapInArrow(run, ", ".join([*fields, "ids_crc32 long"]))
