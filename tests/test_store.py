"""Run folders, the books that follow from events, and compaction."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.operators.normalize import parse_csv
from feedweave.plans import ingest

COLUMNS = "id string, title string, description string, value string, category string, timestamp string"


class Killed(BaseException):
    """The process ends: nothing after it runs."""


class Clock:
    def __init__(self):
        self.now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

    def __call__(self):
        self.now += dt.timedelta(seconds=9)
        return self.now


@pytest.fixture
def lake(spark, tmp_path):
    return ingest.Lake(spark, str(tmp_path / "lake"), clock=Clock())


def feed_of(spark, rows):
    df = spark.createDataFrame([(k, t, "d", str(v), "c", at) for k, t, v, at in rows], COLUMNS)
    return ingest.csv_rows_feed(lambda: parse_csv(df))


def five(spark):
    return feed_of(spark, [(f"ore{i}", f"Ore {i}", i, f"2023-05-0{i + 1} 00:00:00") for i in range(5)])


def files(lake, table):
    return {p: p.stat().st_mtime_ns for p in Path(table.path).rglob("*.parquet")}


def rows(table):
    return sorted(map(str, table.read().collect()))


@pytest.mark.parametrize("window", ["before the event", "after the event", "in the data"])
def test_books_after_a_crash(spark, lake, window, monkeypatch):
    """Wherever the process ends, the repeated batch leaves the same rows, counters, checkpoint and run."""
    note, write = lake._note, lake.records.write

    def dies(run_id, source, status, *a, **k):
        if status == "success" and window == "before the event":
            raise Killed
        seq = note(run_id, source, status, *a, **k)
        if status == "success":
            raise Killed
        return seq

    def half(run_id, found, **k):
        write(run_id, found.limit(2), **k)
        raise Killed

    if window == "in the data":
        monkeypatch.setattr(lake.records, "write", half)
    else:
        monkeypatch.setattr(lake, "_note", dies)
    with pytest.raises(Killed):
        lake.run(five(spark), batch=("stream", 3))
    monkeypatch.undo()
    if window != "after the event":
        assert lake.records.read().count() == 0 and lake.raw.read().count() == 0
        assert lake.runs().first()["status"] == "running"
    again = lake.run(five(spark), batch=("stream", 3))
    assert (again.status, again.inserted, again.updated, again.processed) == ("success", 5, 0, 5)
    run = lake.runs().collect()
    assert [(r["status"], r["records_inserted"], r["records_processed"]) for r in run] == [("success", 5, 5)]
    point = lake.checkpoints.read().first()
    assert (point["status"], point["records_processed"]) == ("success", 5)
    assert point["last_processed_timestamp"] == dt.datetime(2023, 5, 5)
    assert lake.records.read().count() == 5
    assert {r["updated_at"] for r in lake.records.read().collect()} == {None}


def test_a_failed_batch_leaves_no_rows_in_the_logs(spark, lake):
    bad = spark.createDataFrame([("x", None, "d", "1", "c", None)], COLUMNS)

    def broken():
        return parse_csv(bad)

    write = lake.quarantine.write

    def fails(*a, **k):
        write(*a, **k)
        raise OSError("disk full")

    lake.quarantine.write = fails
    assert lake.run(ingest.csv_rows_feed(broken), batch=("s", 0)).status == "failure"
    assert lake.quarantine.read().count() == 0
    lake.quarantine.write = write
    assert lake.run(ingest.csv_rows_feed(broken), batch=("s", 0)).failed == 1
    assert lake.quarantine.read().count() == 1
    assert [r["status"] for r in lake.runs().collect()] == ["success"]


def test_an_update_rewrites_no_file(spark, lake):
    many = [(f"k{i}", f"T{i}", i, None) for i in range(400)]
    lake.run(feed_of(spark, many), incremental=False)
    before = files(lake, lake.records) | files(lake, lake.raw)
    done = lake.run(feed_of(spark, [(k, "new", v, at) for k, _, v, at in many[:65]] + [("other", "O", 1, None)]), incremental=False)
    assert (done.inserted, done.updated) == (1, 65)
    after = files(lake, lake.records) | files(lake, lake.raw)
    assert before.items() <= after.items() and len(after) > len(before)
    found = {r["source_id"]: r for r in lake.records.read().collect()}
    assert len(found) == 401 and sum(r["title"] == "new" for r in found.values()) == 65
    assert sum(r["updated_at"] is not None for r in found.values()) == 65


def test_skipped_rows_are_neither_resolved_nor_staged(spark, lake):
    lake.run(five(spark))

    def strategy(clues, book):
        return F.when(clues.title != "Ore 9", F.raise_error(F.lit("resolved")).cast("string")).otherwise("nine")

    strict = ingest.Lake(spark, lake.root, cascade=[strategy], clock=lake.clock)
    rows_ = [(f"ore{i}", f"Ore {i}", i, f"2023-05-0{i + 1} 00:00:00") for i in range(5)] + [("ore9", "Ore 9", 9, "2023-06-01 00:00:00")]
    done = strict.run(feed_of(spark, rows_))
    assert (done.status, done.processed, done.skipped) == ("success", 1, 5)


def test_compaction(spark, lake, monkeypatch):
    lake.run(five(spark), incremental=False)
    lake.run(feed_of(spark, [("ore1", "second", 7, None), ("ore8", "eighth", None, None), ("bad", None, 1, None)]), incremental=False)
    lake.override(spark.createDataFrame([("csv_ore1", "fixed")], "source_id string, canonical_id string"))
    views = [lake.records, lake.raw, lake.quarantine, lake.drift_log, lake.checkpoints]
    want, runs = [rows(v) for v in views], sorted(map(str, lake.runs().collect()))
    assert any("fixed" in r for r in want[0]) and "eighth" in "".join(want[0])
    updated = {r["source_id"]: r["updated_at"] is not None for r in lake.records.read().collect()}
    assert updated == {"csv_ore1": True} | {f"csv_ore{i}": False for i in (0, 2, 3, 4, 8)}

    # One that dies before its event changes nothing.
    note = lake._note
    monkeypatch.setattr(lake, "_note", lambda *a, **k: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        lake.compact()
    monkeypatch.setattr(lake, "_note", note)
    assert [rows(v) for v in views] == want
    # One that dies while it deletes has already changed all it had to.
    dropped = []
    monkeypatch.setattr(ingest, "drop_folder", lambda *a: (_ for _ in ()).throw(Killed()) if dropped else dropped.append(a))
    with pytest.raises(Killed):
        lake.compact()
    monkeypatch.undo()
    assert [rows(v) for v in views] == want
    lake.compact()
    assert [rows(v) for v in views] == want and sorted(map(str, lake.runs().collect())) == runs
    assert len(lake.records.runs()) == 1 and len(lake.quarantine.runs()) == 1
    assert len(list(Path(lake.root, "events").iterdir())) <= 2
    # Later runs merge with the joined rows.
    lake.run(feed_of(spark, [("ore1", "third", 7, None)]), incremental=False)
    again = {r["source_id"]: r for r in lake.records.read().collect()}
    assert again["csv_ore1"]["title"] == "third" and len(again) == 6
    assert [r for r in rows(lake.raw) if "ore1" in r and "third" in r]


def test_a_folder_of_older_columns(spark, lake):
    """A run stored before canonical_id existed is read beside a new one."""
    lake.run(five(spark), incremental=False)
    home = lake.records.home(lake.records.runs()[0])
    old = spark.read.parquet(home).drop("canonical_id")
    spark.createDataFrame(old.collect(), old.schema).write.mode("overwrite").parquet(home)
    lake.run(feed_of(spark, [("new", "Tether", 1, None)]), incremental=False)
    ids = {r["source_id"]: r["canonical_id"] for r in lake.records.read().collect()}
    assert ids == {"csv_new": "tether"} | {f"csv_ore{i}": None for i in range(5)}
    lake.backfill()
    assert {r["canonical_id"] for r in lake.records.read().collect()} == {"tether", *(f"ore-{i}" for i in range(5))}
    assert {r["updated_at"] for r in lake.records.read().collect()} == {None}


def test_backfill_resolves_only_what_lacks_an_id(spark, lake):
    lake.run(five(spark), incremental=False)
    lake.backfill()
    assert spark.read.parquet(lake.records.home(lake.records.runs()[0])).count() == 0
    assert lake.records.schema == schemas.RECORDS and lake.records.read().schema.fieldNames() == schemas.RECORDS.fieldNames()


def test_a_look_up_skips_row_groups(spark, lake):
    """An id that lies between those stored, but is none of them, opens no row group: its Bloom filter says so."""
    rows_ = spark.range(20_000).select(
        F.lit("csv").alias("source_type"), F.concat(F.lit("k"), F.col("id") * 2).alias("source_id"),
        F.concat(F.lit("e"), F.col("id") * 2).alias("canonical_id"))
    for f in schemas.RECORDS.fields[3:]:
        rows_ = rows_.withColumn(f.name, F.lit(None).cast(f.dataType))
    lake.change(rows_)

    def read(condition):
        found = lake.records.read().filter(condition)
        plan = found._jdf.queryExecution().executedPlan()
        n = len(found.collect())
        scan = plan.executedPlan().collectLeaves().head() if "AdaptiveSparkPlan" in plan.nodeName() else plan.collectLeaves().head()
        return n, scan.metrics().apply("numOutputRows").value(), plan.toString()

    n, scanned, plan = read("canonical_id = 'e777'")
    assert (n, scanned) == (0, 0) and "EqualTo(canonical_id,e777)" in plan
    assert read("source_id = 'k779'")[:2] == (0, 0)
    assert read("canonical_id = 'e778'")[0] == 1


def test_distinct_entities_over_runs_without_their_rows(spark, lake):
    """Overlapping runs and a compaction: within three standard errors (5.4 %), and the records need not be there any more."""
    def rows_of(low, high):
        found = spark.range(low, high).select(F.lit("csv").alias("source_type"), F.concat(F.lit("k"), "id").alias("source_id"),
                                              F.concat(F.lit("e"), F.col("id") % 20_000).alias("canonical_id"))
        for f in schemas.RECORDS.fields[3:]:
            found = found.withColumn(f.name, F.lit(None).cast(f.dataType))
        return found

    for low, high in ((0, 9_000), (5_000, 14_000), (12_000, 45_000)):
        lake.change(rows_of(low, high))
    want = {None: 20_000, "csv": 20_000}
    for _ in range(2):
        got = {r["source_type"]: r["entities"] for r in lake.distinct_entities().collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - n) <= 0.054 * n for k, n in want.items())
        lake.compact()
    lake.records.path = lake.records.path + "-gone"
    assert abs(lake.distinct_entities().first()["entities"] - 20_000) <= 0.054 * 20_000
