"""Incremental pickup of new input with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedweave.plans.ingest import Feed, Lake
from feedweave.session import entries


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str
) -> DataFrame:
    """New files under ``path`` (parquet, csv, json, text or xml) as a stream."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def deduplicated(stream: DataFrame, key: str = "source_id", event_time: str | None = None,
                 delay: str = "1 day") -> DataFrame:
    """Drop repeated keys across batches.

    With an event time, keys are forgotten after ``delay`` and the state stays bounded; the
    merge still recognises a repeat that comes later. Without one, every key is remembered in the state store; what is to be
    written once and kept is better written by ``distinct_into``, which keeps no state.
    """
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def distinct_into(stream: DataFrame, path: str, checkpoint: str, key: str = "source_id", name: str | None = None) -> StreamingQuery:
    """Write each key of a stream once, whichever batch brings it first, and keep no state.

    What has been written is the memory: a batch drops its own repeats, then the keys that other batches have stored (only
    the key column is read for it), and writes a folder of its own, which a repeated batch replaces. So nothing grows in the state
    store however late a repeat comes, and a key is never lost for being late. Read the rows with ``spark.read.parquet(path)``.
    """

    def take_in(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        fresh = rows.dropDuplicates([key])
        stored = [f"{path}/{n}" for n in entries(spark, path) if n.startswith("batch=") and n != f"batch={batch_id}"]
        if stored:
            fresh = fresh.join(spark.read.schema(rows.schema).parquet(*stored).select(key), key, "left_anti")
        fresh.select(*rows.columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(availableNow=True).start()


def into_lake(
    stream: DataFrame, lake: Lake, feed: Feed, parse: Callable[[DataFrame], DataFrame],
    checkpoint: str, name: str, incremental: bool = False, continuous: str | None = None,
) -> StreamingQuery:
    """Upsert a stream of feed rows into the lake, batch by batch.

    Each micro-batch is one run, known by the id that Spark keeps in ``checkpoint`` and the batch's
    number. A batch that Spark repeats after a failure is taken in and counted once; a new checkpoint folder
    is a new stream, whatever its name, and brings its rows again. A failed run fails the batch, and the next
    start resumes with it. ``incremental`` drops rows at or below the high-water mark.
    ``continuous`` keeps the query running at that interval; by default it takes what is
    there and stops.
    """

    def take_in(rows: DataFrame, batch_id: int) -> None:
        batch_feed = replace(feed, parse=lambda: parse(rows))
        stream_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        result = lake.run(batch_feed, incremental=incremental, batch=(stream_id, batch_id))
        if result.status != "success":
            raise RuntimeError(result.error)

    writer = stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.queryName(name).trigger(**trigger).start()
