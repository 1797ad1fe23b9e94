import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.operators import merge as M
from feedweave.operators.validate import audit

def as_of():
    return F.lit("2024-06-01").cast("timestamp")


OLD = dt.datetime(2024, 1, 1)


def record(key, title, value=1.0, tags=("t",), canonical="c", at=OLD):
    return ("csv", key, canonical, title, None, value, "cat", list(tags) if tags else None, None, at, None, {"k": "v"})


@pytest.fixture
def target(spark):
    return spark.createDataFrame([record("a", "A"), record("b", "B")], schemas.RECORDS)


@pytest.fixture
def updates(spark):
    rows = [record("b", "B2", None, None, None, dt.datetime(2024, 5, 1)), record("c", "C", at=dt.datetime(2024, 5, 1))]
    return spark.createDataFrame(rows, schemas.RECORDS)


def test_merge_semantics(target, updates):
    got = {r["source_id"]: r for r in M.merge_records(target, updates, as_of()).collect()}
    assert {k: r["merge_action"] for k, r in got.items()} == {"a": "keep", "b": "update", "c": "insert"}
    b = got["b"]
    assert (b["title"], b["value"], b["tags"], b["canonical_id"]) == ("B2", None, None, None)
    assert b["created_at"] == OLD and b["updated_at"] == dt.datetime(2024, 6, 1)
    assert got["c"]["created_at"] == dt.datetime(2024, 5, 1) and got["c"]["updated_at"] is None
    assert got["a"]["updated_at"] is None


def test_repeating_changes_nothing(target, updates):
    def rows(df):
        return sorted(map(str, df.drop("merge_action").collect()))

    once = M.merge_records(target, updates, as_of())
    again = M.merge_records(once.drop("merge_action"), updates, as_of())
    c_once = once.withColumn("updated_at", F.lit(None))
    assert rows(again.withColumn("updated_at", F.lit(None))) == rows(c_once)
    assert again.select("source_id").distinct().count() == again.count()


def test_merge_shuffles_once_and_joins_nothing(target, updates):
    plan = M.merge_records(target, updates, as_of())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_raw_upsert_keeps_the_first_ingest_time(spark):
    later = dt.datetime(2024, 5, 1)
    old = spark.createDataFrame([("csv", "a", "csv", "{1}", OLD)], schemas.RAW_RECORDS)
    new = spark.createDataFrame([("csv", "a", "csv", "{2}", later), ("csv", "b", "csv", "{3}", later)], schemas.RAW_RECORDS)
    got = {r["source_id"]: r for r in M.merge_raw(old, new).collect()}
    assert (got["a"]["raw_data"], got["a"]["ingested_at"]) == ("{2}", OLD)
    assert got["b"]["ingested_at"] == later


def test_last_wins_drops_losers_before_the_shuffle(spark):
    # A third of the rows share one key.
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") < 10_000, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq")
    )
    latest = M.last_wins(df, ["k"], [F.col("seq")])
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()
    assert latest.count() == 20_001
    assert latest.filter("k = -1").first()["seq"] == 9_999


def test_counts_equal_row_by_row_processing(spark):
    rows = [("csv", k, r, s) for k, r, s in [
        ("a", [], False), ("a", [], False), ("b", ["bad"], False), ("b", [], False), ("c", [], True), ("d", ["bad"], False),
    ]]
    batch = spark.createDataFrame(rows, "source_type string, source_id string, reasons array<string>, skipped boolean")
    known = spark.createDataFrame([("b",)], "source_id string")
    got = M.ingest_counts(batch, known).first().asDict()
    seen, inserted, updated = {"b"}, 0, 0
    for _, key, reasons, skipped in rows:
        if not reasons and not skipped:
            inserted += key not in seen
            updated += key in seen
            seen.add(key)
    assert (got["records_inserted"], got["records_updated"]) == (inserted, updated)
    assert (got["records_processed"], got["records_failed"], got["records_skipped"]) == (inserted + updated, 2, 1)


def test_audit_finds_each_violation(spark, target):
    bad = spark.createDataFrame([record("a", "A"), record("x" * 300, "t" * 501), record(None, None)], schemas.RECORDS)
    got = {r["rule"]: r["violations"] for r in audit(target.unionByName(bad)).collect()}
    assert got["source_id_repeated"] == 1 and got["source_id_too_long"] == 1 and got["source_id_null"] == 1
    assert got["title_null"] == 1 and got["title_too_long"] == 1 and got["source_type_unknown"] == 0


def test_add_columns(spark, target):
    old = target.drop("canonical_id")
    assert M.add_columns(old, target).columns == target.columns
    assert M.add_columns(old, target).filter("canonical_id is not null").isEmpty()


def test_latest_sorts_no_rows(spark):
    """The last row of each key, told by a join with the keys that repeat: no row is sorted."""
    rows = [("a", 1, "x"), ("b", 2, "x"), ("a", 5, "y"), (None, 3, "x"), (None, 4, "y"), ("c", 6, "x"), ("a", 0, "z")]
    found = M.latest(spark.createDataFrame(rows, "key string, place long, text string"), "key", "place")
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 5, "y"), ("b", 2, "x"), ("c", 6, "x"), (None, 4, "y")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
