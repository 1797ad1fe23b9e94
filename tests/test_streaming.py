import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave.operators import bookkeeping as B
from feedweave.operators.normalize import parse_csv
from feedweave.plans import ingest
from feedweave.streaming import incremental

COLUMNS = "id string, title string, description string, value string, category string, timestamp string"


class Clock:
    def __init__(self):
        self.now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

    def __call__(self):
        self.now += dt.timedelta(seconds=7)
        return self.now


def land(spark, folder, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def row(i, value=1):
    return (f"k{i}", f"T{i}", "d", str(value), "c", f"2024-01-{i:02d} 00:00:00")


@pytest.fixture
def setting(spark, tmp_path):
    lake = ingest.Lake(spark, str(tmp_path / "lake"), clock=Clock())
    landing = str(tmp_path / "landing")
    feed = ingest.csv_rows_feed(lambda: None)

    def start(parse=parse_csv, incremental_run=False):
        schema = spark.createDataFrame([], COLUMNS).schema
        stream = incremental.stream_files(spark, landing, schema)
        return incremental.into_lake(stream, lake, feed, parse, str(tmp_path / "progress"), "events", incremental_run)

    return lake, landing, start


def test_stop_and_resume(spark, setting):
    lake, landing, start = setting
    land(spark, landing, [row(1), row(2)])
    start().awaitTermination()
    assert lake.records.read().count() == 2

    # The next batch fails after its data was read; a restart takes it in, once.
    land(spark, landing, [row(2, 5), row(3)])

    def broken(df):
        return parse_csv(df).withColumn("title", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        start(broken).awaitTermination()
    assert B.should_resume(lake.checkpoints.read(), "csv")
    assert lake.records.read().count() == 2
    start().awaitTermination()
    rows = {r["source_id"]: r for r in lake.records.read().collect()}
    assert {k: r["value"] for k, r in rows.items()} == {"csv_k1": 1.0, "csv_k2": 5.0, "csv_k3": 1.0}
    assert rows["csv_k2"]["updated_at"] is not None
    assert not B.should_resume(lake.checkpoints.read(), "csv")
    assert lake.checkpoints.read().first()["records_processed"] == 4
    assert sorted(r["status"] for r in lake.runs().collect()) == ["success", "success"]


def test_repeated_batch_is_taken_in_once(spark, setting):
    lake, _, _ = setting
    df = spark.createDataFrame([row(1)], COLUMNS)
    feed = ingest.csv_rows_feed(lambda: parse_csv(df))
    lake.run(feed, incremental=False, batch=("s", 0))
    events = lake.events().count()
    assert lake.run(feed, incremental=False, batch=("s", 0)).status == "success"
    assert lake.events().count() == events
    assert lake.records.read().count() == 1 and lake.drift_log.read().count() == 0
    assert lake.checkpoints.read().first()["records_processed"] == 1
    assert [r["records_inserted"] for r in lake.runs().collect()] == [1]


def test_a_new_stream_of_the_same_name_brings_its_rows(spark, tmp_path):
    lake = ingest.Lake(spark, str(tmp_path / "lake"), clock=Clock())
    schema = spark.createDataFrame([], COLUMNS).schema
    for i, folder in enumerate(("one", "two")):
        land(spark, str(tmp_path / folder), [row(i)])
        stream = incremental.stream_files(spark, str(tmp_path / folder), schema)
        incremental.into_lake(stream, lake, ingest.csv_rows_feed(lambda: None), parse_csv, str(tmp_path / f"p-{folder}"),
                              "events").awaitTermination()
    assert lake.records.read().count() == 2
    assert sum(r["records_inserted"] for r in lake.runs().collect()) == 2


def test_late_rows_are_skipped(spark, setting):
    lake, landing, start = setting
    land(spark, landing, [row(5)])
    start(incremental_run=True).awaitTermination()
    land(spark, landing, [row(4), row(6), ("k9", "no time", "d", "1", "c", None)])
    start(incremental_run=True).awaitTermination()
    assert sorted(r["source_id"] for r in lake.records.read().collect()) == ["csv_k5", "csv_k6", "csv_k9"]
    assert lake.checkpoints.read().first()["last_processed_timestamp"] == dt.datetime(2024, 1, 6)


def test_duplicates_within_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source_id string, s long").select(
        "source_id", F.timestamp_seconds("s").alias("at"))
    df.write.parquet(folder)
    stream = incremental.stream_files(spark, folder, df.schema)
    query = incremental.deduplicated(stream, "source_id", "at", "1 hour").writeStream.format("memory").queryName(
        "dedup_out").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["source_id"] for r in spark.table("dedup_out").collect()) == ["a", "b"]


def test_each_key_once_without_state(spark, tmp_path):
    """Repeats within a batch, across batches and of a batch delivered again; the state store holds no row."""
    landing, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "source_id string, n int"
    for rows in ([("a", 1), ("a", 1), ("b", 1)], [("b", 2), ("c", 2), (None, 2)], [("a", 3), ("c", 3), ("d", 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = incremental.stream_files(spark, landing, spark.createDataFrame([], schema).schema)
        query = incremental.distinct_into(stream, out, progress)
        query.awaitTermination()
        assert query.lastProgress is None or query.lastProgress["stateOperators"] == []
    got = sorted((r["source_id"] or "", r["n"]) for r in spark.read.parquet(out).select("source_id", "n").collect())
    assert got == [("", 2), ("a", 1), ("b", 1), ("c", 2), ("d", 3)]
