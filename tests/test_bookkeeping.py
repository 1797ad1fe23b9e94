import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.operators import bookkeeping as B

T = [dt.datetime(2024, 1, 1, h) for h in range(10)]


def update(seq, status, n=0, id=None, ts=None, error=None, meta=None):
    return ("csv", seq, T[seq], status, n, id, ts, error, meta)


def fold(spark, *rounds):
    current = B.no_checkpoints(spark)
    for rows in rounds:
        current = B.merge_checkpoints(current, spark.createDataFrame(list(rows), schemas.CHECKPOINT_UPDATES))
    return current.first()


ROUNDS = [
    [update(0, "running", 50, id="r50"), update(1, "success", 50, id="record_100", ts=T[0])],
    [update(0, "running"), update(1, "failure", 3, error="boom"), update(2, "running")],
    [update(0, "failure", 1, error="boom", meta={"a": "1"}), update(1, "success", 2)],
]


def test_accumulates(spark):
    row = fold(spark, ROUNDS[0])
    assert (row["records_processed"], row["last_processed_id"], row["status"]) == (100, "record_100", "success")
    assert row["last_success_at"] == T[1] and row["last_processed_timestamp"] == T[0]


def test_error_lives_until_success(spark):
    row = fold(spark, ROUNDS[1])
    assert (row["status"], row["error_message"], row["last_failure_at"]) == ("running", "boom", T[1])
    row = fold(spark, ROUNDS[2])
    assert row["error_message"] is None and row["extra_metadata"] == {"a": "1"}


@pytest.mark.parametrize("rows", ROUNDS)
def test_one_by_one_equals_together(spark, rows):
    assert fold(spark, rows) == fold(spark, *[[r] for r in rows])


def test_resume(spark):
    assert B.should_resume(B.merge_checkpoints(B.no_checkpoints(spark), spark.createDataFrame(ROUNDS[1], schemas.CHECKPOINT_UPDATES)), "csv")
    assert not B.should_resume(B.merge_checkpoints(B.no_checkpoints(spark), spark.createDataFrame(ROUNDS[0], schemas.CHECKPOINT_UPDATES)), "csv")
    assert not B.should_resume(B.no_checkpoints(spark), "csv")


def test_high_water(spark):
    mark = dt.datetime(2024, 1, 15, 10, 30)
    rows = [("csv", 0, T[0], "success", 0, None, mark, None, None), ("rss", 0, T[0], "success", 0, None, None, None, None)]
    points = B.merge_checkpoints(B.no_checkpoints(spark), spark.createDataFrame(rows, schemas.CHECKPOINT_UPDATES))
    assert B.high_water(points, "csv") == mark and B.high_water(points, "rss") is None and B.high_water(points, "x") is None
    second = dt.timedelta(seconds=1)
    data = [("csv", mark), ("csv", mark + second), ("csv", None), ("rss", mark), ("api1", mark - second)]
    df = spark.createDataFrame(data, "source_type string, source_timestamp timestamp")
    kept = sorted((r[0], str(r[1])) for r in B.after_high_water(df, points).collect())
    assert kept == sorted((s, str(t)) for s, t in data[1:])


def test_run_completion(spark):
    end = T[1] + dt.timedelta(seconds=12.5)
    events = [
        ("r1", "csv", T[1], "running", 0, 0, 0, 0, None, {"path": "p"}),
        ("r1", "csv", end, "success", 100, 80, 20, 0, None, {}),
        ("r2", "csv", T[2], "running", 0, 0, 0, 0, None, {}),
    ]
    runs = {r["run_id"]: r for r in B.runs_from_events(spark.createDataFrame(events, schemas.RUN_EVENTS)).collect()}
    one = runs["r1"]
    assert (one["duration_seconds"], one["records_inserted"], one["status"]) == (12.5, 80, "success")
    assert one["extra_metadata"] == {"path": "p"}
    assert runs["r2"]["status"] == "running" and runs["r2"]["completed_at"] is None
