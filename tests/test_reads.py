import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.operators import entities as E
from feedweave.operators import metrics as X
from feedweave.operators import reads


@pytest.fixture(scope="module")
def records(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [
        (s, f"{s}_{i}", c, f"Title {i} 100%", f"x_{i}", float(i), "even" if i % 2 == 0 else "odd", None, None,
         base + dt.timedelta(hours=i // 3), None, None)
        for i, (s, c) in enumerate([("csv", "a"), ("rss", "a"), ("csv", "b"), ("csv", None), ("api1", "a"), ("csv", "c"), ("csv", "c")] * 5)
    ]
    return spark.createDataFrame(rows, schemas.RECORDS).cache()


def ids(df):
    return [r["source_id"] for r in df.select("source_id").collect()]


def test_page_bounds(records):
    for page, size in [(0, 10), (1, 0), (1, 1001)]:
        with pytest.raises(ValueError):
            reads.page_of(records, page, size)
    assert reads.page_info(records, 2, 10).first().asDict() == {
        "page": 2, "page_size": 10, "total_records": 35, "total_pages": 4, "filters_applied": None}


def test_pages_cover_everything_once(records):
    pages = [ids(reads.page_of(records, p, 8)) for p in range(1, 6)]
    assert [len(p) for p in pages] == [8, 8, 8, 8, 3]
    assert len(set(sum(pages, []))) == 35


def test_deep_pages_equal_plain_pages(records):
    for offset in (0, 5, 17, 33, 40):
        want = ids(records.orderBy(F.desc("created_at"), "source_id").offset(offset).limit(6))
        assert ids(reads.deep_page(records, offset, 6)) == want


@pytest.mark.parametrize("ranges", [3, 1000])
def test_deep_pages_over_ties_nulls_and_long_common_ids(spark, records, monkeypatch, ranges):
    """Seeking goes on from the time to the id when very many rows share a time, and through what ids have in common."""
    monkeypatch.setattr(reads, "TOP_ROWS", 5)
    monkeypatch.setattr(reads, "RANGES", ranges)
    day = dt.datetime(2024, 3, 1)
    times = [None] * 40 + [day] * 90 + [dt.datetime(1960, 1, 1), dt.datetime(2300, 1, 1), day + dt.timedelta(microseconds=1)]
    rows = [("csv", f"a long common start é{i * 7919 % 1000:04d}{'tail' * (i % 3)}", *[None] * 7, at, None, None) for i, at in enumerate(times)]
    rows += [("csv", "twin", *[None] * 7, day, None, None)] * 12
    many = spark.createDataFrame(rows, schemas.RECORDS).repartition(5).cache()
    want = ids(many.orderBy(F.desc_nulls_last("created_at"), "source_id"))
    for offset in (0, 1, 2, 44, 93, 100, 106, 130, 143):
        assert ids(reads.deep_page(many, offset, 4)) == want[offset : offset + 4]
    assert reads.deep_page(many, len(want), 4).count() == 0 and reads.deep_page(many.limit(0), 0, 4).count() == 0


def test_registered_reads_push_their_filters_into_the_scan(spark):
    from feedweave.plans import catalog

    catalog.load()
    for name, pushed in (("data_page", "EqualTo(event_type,purchase)"), ("entity_history", "EqualTo(event_type,signup)"),
                         ("recent_by_source", "GreaterThanOrEqual(ts,"), ("data_page_meta", "EqualTo(event_type,view)")):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("PushedFilters: ["):]
        assert pushed in scan[: scan.index("ReadSchema")]


def test_filters(records):
    assert reads.matching(records, source_type="", category="", search="").count() == 35
    assert reads.matching(records, source_type="csv", category="odd", canonical_id="c").count() == 5
    assert reads.matching(records, search="tItLe 7").count() == 1
    assert reads.matching(records, search="x_1_").count() == 10
    assert reads.matching(records, search=r"x\_1").count() == 11
    assert reads.matching(records, search=r"100\%").count() == 35
    assert reads.matching(records, search=r"\q").count() == 0


def test_entity(records):
    got = reads.entity_records(records, "a").collect()
    assert [r["source_type"] for r in got] == sorted(r["source_type"] for r in got) and len(got) == 15
    with pytest.raises(LookupError):
        reads.require_rows(reads.entity_records(records, "nobody"), "nobody")


def test_entity_analytics(records):
    many = {r["canonical_id"]: r for r in E.in_many_sources(records).collect()}
    assert set(many) == {"a"}
    assert (many["a"]["sources"], many["a"]["source_count"], many["a"]["record_count"]) == ("api1,csv,rss", 3, 15)
    assert E.count_ids(records).first()[0] == 3
    assert [r["canonical_id"] for r in E.with_many_records(records, 2).collect()] == ["a", "c"]
    shared = E.with_counterpart(records).collect()
    rows = records.collect()
    want = {r["source_id"] for r in rows if any(
        o["canonical_id"] == r["canonical_id"] and o["source_type"] != r["source_type"]
        for o in rows if r["canonical_id"] is not None)}
    assert {r["source_id"] for r in shared} == want
    pairs = {(r["canonical_id"], r["source_type"]): r["other_source_type"] for r in E.counterpart(records).collect()}
    assert pairs == {("a", "api1"): "csv", ("a", "csv"): "api1", ("a", "rss"): "api1"}


def test_runs_limit_and_empty_health(spark):
    runs = spark.createDataFrame([], schemas.RUNS)
    for limit in (0, 101):
        with pytest.raises(ValueError):
            reads.recent_runs(runs, limit)
    assert reads.health(spark.createDataFrame([], schemas.CHECKPOINTS)).first().asDict() == {
        "etl_last_run": None, "etl_status": "unknown"}


def test_trailing_calls_match_brute_force(spark):
    second = 1_000_000
    moments = [0, 0, 30 * second, 59 * second, 60 * second - 1, 60 * second, 119 * second, 120 * second, 3599 * second, 3600 * second, 3600 * second, 3659 * second + 999_999]
    calls = [("s", m) for m in moments] + [("r", 5), ("r", 60 * second + 4), ("r", 60 * second + 5)]
    df = spark.createDataFrame(calls, "s string, us long").select("s", F.timestamp_micros("us").alias("ts"), "us")
    got = {(r["source"], r["us"]): r["in_window"] for r in X.trailing_calls(df, "s", "ts", 60).withColumn("us", F.unix_micros("ts")).collect()}
    want = {(s, m): sum(1 for s2, o in calls if s2 == s and 0 <= m - o < 60 * second) for s, m in calls}
    assert got == want
    report = {r["source"]: r for r in X.rate_report(df, "s", "ts", limit=3, period_seconds=60).collect()}
    assert report["s"]["calls"] == 12 and report["s"]["peak_calls"] == max(v for k, v in want.items() if k[0] == "s")
    assert report["s"]["violations"] == sum(1 for s, m in calls if s == "s" and want[(s, m)] > 3)


def test_a_busy_hour_spreads_over_tasks(spark, monkeypatch):
    """One source with all its calls in one hour fills several ranges, and sums go on across them."""
    calls = [("busy", i * 1_000_003 % 3_000_000_000) for i in range(3000)] + [(None, 7), (None, 8)]
    df = spark.createDataFrame(calls, "s string, us long").select("s", F.timestamp_micros("us").alias("ts"))
    staged = []
    keep = X.stage
    monkeypatch.setattr(X, "stage", lambda rows, label: staged.append(keep(rows, label)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = X.trailing_calls(df, "s", "ts", 300).withColumn("us", F.unix_micros("ts")).collect()
        sizes = [r["count"] for r in staged[0].filter("s = 'busy'" if "s" in staged[0].columns else "source = 'busy'").groupBy("range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 2000
    moments = sorted(m for s, m in calls if s)
    for r in got[:200] + got[-200:]:
        if r["source"]:
            assert r["in_window"] == sum(0 <= r["us"] - m < 300_000_000 for m in moments)
    assert sorted(r["in_window"] for r in got if r["source"] is None) == [1, 2]
