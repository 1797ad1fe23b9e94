"""Odd input, repeated and late batches, and what the lake keeps of its runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.operators import drift as D
from feedweave.operators.normalize import MARKET_FEED, TICKER_FEED, parse_api, parse_csv, parse_rss, to_records
from feedweave.operators.resolve import AliasBook
from feedweave.plans import ingest
from feedweave.plans import tables as t
from feedweave.plans.catalog import query
from feedweave.session import fresh_dir
from feedweave.sources import archive, files
from feedweave.streaming import incremental


def _lake(spark, name, **settings):
    at = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
    return ingest.Lake(spark, fresh_dir(spark, name), clock=lambda: at, **settings)


def _ran(result):
    if result.status != "success":
        raise RuntimeError(result.error)
    return result


def _lines(rows, header, path, parts=8):
    """Text files of ``rows`` (one column, ``line``), each under a header line."""
    spark = rows.sparkSession
    body = rows.select(F.pmod(F.xxhash64("line"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("place"), "line")
    heads = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("place"), F.lit(header).alias("line"))
    dealt = body.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    dealt.select("part", "line").write.partitionBy("part").text(path)


@query("""SELECT CASE WHEN o_orderkey % 50 <> 0 THEN 'csv_' || o_orderkey END AS source_id, o_orderkey % 50 = 0 AS surplus,
CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey || ',' || o_orderstatus || ',1.5,more,"a, b"' END AS line FROM orders""")
def scan_csv_malformed(spark, folder):
    """Rows with more cells than the header are kept apart as they are."""
    path = fresh_dir(spark, "csv")
    cells = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.lit("1.5"))
    bad = F.col("o_orderkey") % 50 == 0
    lines = t.table(spark, folder, "orders").select(
        F.when(bad, F.concat(cells, F.lit(',more,"a, b"'))).when(F.col("o_orderkey") % 50 == 1, F.substring_index(cells, ",", 2))
        .otherwise(cells).alias("line"))
    _lines(lines, "id,title,value", path)
    parsed = parse_csv(files.read_csv(spark, path, unreadable=True))
    surplus = F.array_contains("reasons", "surplus_cells")
    return parsed.select(F.when(~surplus, F.col("source_id")).alias("source_id"), surplus.alias("surplus"),
                         F.when(surplus, F.col("raw_data")).alias("line"))


@query("""SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS title, CASE WHEN o_orderkey % 3 < 2 THEN o_totalprice END AS value,
CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus END AS category FROM orders""")
def scan_csv_mixed_headers(spark, folder):
    """Files of one feed whose headers differ in order and in columns."""
    path = fresh_dir(spark, "csv")
    rows = t.order_rows(spark, folder).withColumn("file", F.col("id").cast("long") % 3)
    for i, columns in enumerate((["id", "title", "value"], ["value", "id", "title"], ["category", "title", "id"])):
        rows.filter(F.col("file") == i).select(*columns).write.mode("append").option("header", True).csv(path)
    found = files.read_csv(spark, path)
    return found.select("id", "title", F.col("value").cast("double").alias("value"), "category")


@query("""SELECT p_partkey::VARCHAR AS id, 'ok' AS state FROM part WHERE p_partkey % 6 IN (0, 1, 2)
UNION ALL SELECT NULL, CASE WHEN p_partkey % 6 = 5 THEN 'not_an_object' ELSE 'not_a_list' END FROM part WHERE p_partkey % 6 > 2""")
def scan_json_odd_payloads(spark, folder):
    """Responses whose list is none, or that are no JSON, are rows to be quarantined."""
    path = fresh_dir(spark, "json")
    record = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name")))
    shape = F.col("p_partkey") % 6
    body = (
        F.when(shape == 0, record).when(shape == 1, F.concat(F.lit('{"data":['), record, F.lit("]}")))
        .when(shape == 2, F.concat(F.lit("["), record, F.lit("]"))).when(shape == 3, F.concat(F.lit('{"data":'), record, F.lit("}")))
        .when((shape == 4) & (F.col("p_partkey") % 12 == 4), F.lit('{"results":null}'))
        .when(shape == 4, F.lit('{"data":"none","results":[{"id":"x"}]}')).otherwise(F.concat(F.lit("<"), record))
    )
    t.table(spark, folder, "part").select(body.alias("value")).write.text(path)
    parsed = parse_api(files.read_json_payloads(spark, path), "api2")
    state = (F.when(F.size("reasons") == 0, "ok").when(F.array_contains("reasons", "not_a_list"), "not_a_list")
             .when(F.array_contains("reasons", "not_an_object"), "not_an_object"))
    return parsed.select(F.when(state == "ok", F.col("extra_metadata")["original_id"]).alias("id"), state.alias("state"))


@query("""SELECT 'page ' || page_id AS title, page_id % 7 = 0 AS malformed, CASE WHEN page_id % 7 <> 0 THEN 'https://x/' || page_id END AS link
FROM pages""")
def scan_rss_malformed(spark, folder):
    """An item that is never closed, or is not well-formed, costs no other item."""
    path = fresh_dir(spark, "rss")
    id = F.col("page_id").cast("string")
    good = F.concat(F.lit("<item><title>page "), id, F.lit("</title><link>https://x/"), id, F.lit("</link></item>"))
    bad = F.when(F.col("page_id") % 14 == 0, F.concat(F.lit("<item><title>page "), id, F.lit("<link>https://x/"))).otherwise(
        F.concat(F.lit("<item><title>page "), id, F.lit("<link></title></link></item>")))
    items = t.table(spark, folder, "pages").select(F.when(F.col("page_id") % 7 == 0, bad).otherwise(good).alias("line"))
    _lines(items, "<rss><channel><title>all</title>", path)
    parsed = parse_rss(files.read_rss(spark, path))
    broken = F.array_contains("reasons", "malformed_xml")
    title = F.when(broken, F.regexp_extract("raw_data", "<title>(page [0-9]+)", 1)).otherwise(F.col("title"))
    return parsed.select(title.alias("title"), broken.alias("malformed"),
                         F.when(~broken, F.col("extra_metadata")["link"]).alias("link"))


@query("""SELECT 'csv_' || p_partkey AS source_id, replace(lower(p_name), ' ', '-') AS canonical_id FROM part""")
def ingest_large_dictionary(spark, folder):
    """A run against a dictionary of all part names."""
    part = t.table(spark, folder, "part")
    name = F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))
    symbols = part.select(name.alias("name")).distinct().select(
        F.crc32("name").alias("ord"), F.concat(F.lit("#"), F.col("name")).alias("symbol"), "name")
    rows = part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"))
    lake = _lake(spark, "dictionary", book=symbols)
    _ran(lake.run(ingest.csv_rows_feed(lambda: parse_csv(rows)), incremental=False))
    return lake.records.read().select("source_id", "canonical_id")


@query("""SELECT DISTINCT o_orderkey || ' ' || o_orderpriority AS title, o_orderstatus AS category, TRUE AS same_id FROM orders""")
def renormalize_without_ids(spark, folder):
    """Archived rows of a feed without ids keep the ids that were made of their content."""
    rows = t.table(spark, folder, "orders").select(
        F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("title"), F.col("o_orderstatus").alias("category"))
    lake = _lake(spark, "archive")
    _ran(lake.run(ingest.csv_rows_feed(lambda: parse_csv(rows)), incremental=False))
    before = lake.records.read().select("source_id", F.col("title").alias("old_title"))
    lake.renormalize(archive.archived_csv(lake.raw.read()))
    again = lake.records.read().join(before, "source_id", "left")
    return again.select("title", "category", F.col("title").eqNullSafe(F.col("old_title")).alias("same_id"))


class _Killed(BaseException):
    """The end of a process, at which nothing more is written."""


def _killed(lake, when, run):
    """Run a batch in a process that ends just before or just after the event that makes it count."""
    note = lake._note

    def last(run_id, source, status, *rest, **more):
        if status != "success" or when == "after":
            note(run_id, source, status, *rest, **more)
        if status == "success":
            raise _Killed

    lake._note = last
    try:
        run()
    except _Killed:
        return
    finally:
        lake._note = note
    raise RuntimeError("the process did not end")


@query("""SELECT count(*) * 2 AS records, count(*) * 2 AS records_processed, 2::BIGINT AS runs, count(*) * 2 AS inserted, 'success' AS status FROM events""")
def stream_replay(spark, folder):
    """Two batches, each delivered again after its process ended in the middle: taken in, run and counted once."""
    lake = _lake(spark, "replay")
    for i, when in enumerate(("before", "after")):
        rows = _event_rows(spark, folder).withColumn("id", F.concat(F.lit(f"{i}-"), "id"))
        feed = ingest.csv_rows_feed(lambda rows=rows: parse_csv(rows))

        def deliver():
            return _ran(lake.run(feed, incremental=False, batch=("stream", i)))

        _killed(lake, when, deliver)
        if deliver() != deliver():
            raise RuntimeError("the repeated batch tells another result")
    books = {"records_processed": lake.checkpoints.read().agg(F.sum("records_processed")), "status": lake.checkpoints.read().agg(F.max("status")),
             "runs": lake.runs().agg(F.count("*")), "inserted": lake.runs().agg(F.sum("records_inserted"))}
    return lake.records.read().agg(F.count("*").alias("records")).select("records", *[b.scalar().alias(n) for n, b in books.items()])


def _event_rows(spark, folder):
    return t.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"),
        F.col("value").cast("string").alias("value"), F.col("event_type").alias("category"), F.col("ts").cast("string").alias("timestamp"))


@query("""SELECT 'csv_' || event_id AS source_id, event_type AS title FROM events WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 5 DAY""")
def late_stream(spark, folder):
    """A stream whose second file is older than the mark the first one set: late rows are skipped."""
    lake, path = _lake(spark, "late"), fresh_dir(spark, "landing")
    rows = _event_rows(spark, folder).withColumn("at", F.col("timestamp").cast("timestamp"))
    start = rows.agg(F.min("at").alias("start"))
    rows = rows.withColumn("late", F.col("at") < start.scalar() + F.expr("INTERVAL 5 DAY")).drop("at")
    schema = rows.drop("late").schema
    for late in (False, True):
        rows.filter(F.col("late") == late).drop("late").write.mode("append").parquet(path)
        query = incremental.into_lake(incremental.stream_files(spark, path, schema), lake, ingest.csv_rows_feed(lambda: None),
                                      parse_csv, f"{lake.root}/progress", f"late-{lake.root[-8:]}", incremental=True)
        query.awaitTermination()
    return lake.records.read().select("source_id", "title")


@query("""SELECT 'rss_' || page_id AS source_id, CASE WHEN page_id % 3 = 0 THEN 'published,summary' ELSE 'published' END AS missing FROM pages
WHERE page_id % 5 <> 0 OR page_id % 3 = 0
UNION ALL SELECT 'rss_' || page_id, '' FROM pages WHERE page_id % 5 = 0 AND page_id % 3 <> 0""")
def rss_drift(spark, folder):
    """Elements that entries really lack."""
    id = F.col("page_id")
    entries = t.table(spark, folder, "pages").select(
        id.cast("string").alias("id"), F.concat(F.lit("t"), id.cast("string")).alias("title"), F.col("url").alias("link"),
        F.when(id % 3 != 0, "s").alias("summary"),
        F.when((id % 5 == 0) & (id % 3 != 0), "2024-01-15T10:30:00Z").alias("published"),
        F.array().cast("array<string>").alias("categories"))
    found = D.detect(parse_rss(entries), schemas.EXPECTED_FIELDS["rss"])
    return found.select("source_id", F.array_join(F.array_sort("missing_fields"), ",").alias("missing"))


@query("""SELECT 'api_ticker_' || p_partkey AS source_id, p_brand || ' ' || p_type AS description, p_retailprice AS value, p_size::VARCHAR AS category
FROM part UNION ALL SELECT 'api_market_' || p_partkey, p_brand, p_retailprice,
CASE WHEN p_size <= 10 THEN 'top-10' WHEN p_size <= 100 THEN 'top-100' ELSE 'other' END FROM part""")
def provider_ingest(spark, folder):
    """Provider records through the ingest of their feeds: descriptions, prices and rank categories."""
    part = t.table(spark, folder, "part")
    common = [F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("symbol")]
    price = F.col("p_retailprice")
    shapes = {
        "ticker": (TICKER_FEED, [F.col("p_type").alias("description"), F.col("p_size").alias("rank"),
                                 F.struct(F.struct(price.alias("price")).alias("USD")).alias("quotes")]),
        "market": (MARKET_FEED, [price.alias("current_price"), F.col("p_size").alias("market_cap_rank"),
                                 F.lit("2024-01-15T10:30:00.000Z").alias("last_updated")]),
    }
    lake = _lake(spark, "providers")
    for name, (mapping, more) in shapes.items():
        path = fresh_dir(spark, name)
        part.select(F.to_json(F.struct(*common, *more)).alias("value")).write.text(path)
        _ran(lake.run(ingest.api_feed(spark, path, name, mapping=mapping), incremental=False))
    return lake.records.read().select("source_id", "description", "value", "category")


@query("""SELECT 'csv_' || o_orderkey AS source_id, CASE WHEN o_orderkey % 4 = 0 THEN 'kept' WHEN o_orderkey % 10 = 1 THEN 'corrected'
ELSE lower(o_orderstatus) END AS canonical_id FROM orders""")
def backfill_store(spark, folder):
    """Missing ids of stored rows are filled in and corrections stored; other rows stay."""
    lake = _lake(spark, "backfill", book=AliasBook({}, {s: s for s in "fop"}))
    rows = t.orders(spark, folder).withColumn(
        "canonical_id", F.when(F.regexp_extract("source_id", "([0-9]+)", 1).cast("long") % 4 == 0, "kept"))
    rows = rows.withColumn("title", F.col("category"))
    lake.change(to_records(rows, F.lit("2024-01-01").cast("timestamp")))
    lake.backfill()
    number = F.regexp_extract("source_id", "([0-9]+)", 1).cast("long")
    fixes = lake.records.read().filter((number % 10 == 1) & (number % 4 != 0)).select("source_id", F.lit("corrected").alias("canonical_id"))
    lake.override(fixes)
    return lake.records.read().select("source_id", "canonical_id")


@query("""SELECT 'csv' AS source_name, 'csv_' || event_id AS record_id, 'description' AS missing FROM events""")
def drift_log_store(spark, folder):
    """The drift log of a run, read back from the store."""
    lake = _lake(spark, "drift")
    _ran(lake.run(ingest.csv_rows_feed(lambda: parse_csv(_event_rows(spark, folder))), incremental=False))
    return lake.drift_log.read().select("source_name", "record_id", F.array_join("missing_fields", ",").alias("missing"))


@query("""SELECT 'csv_' || o_orderkey AS source_id, 'csv' AS source_name,
CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS title FROM orders""")
def raw_after_two_runs(spark, folder):
    """The archive after a second run over half of the rows: their raw text is the new one."""
    lake = _lake(spark, "raw")
    for label in ("first", "second"):
        rows = t.order_rows(spark, folder).withColumn("title", F.lit(label))
        if label == "second":
            rows = rows.filter(F.col("id").cast("long") % 2 == 0)
        _ran(lake.run(ingest.csv_rows_feed(lambda rows=rows: parse_csv(rows)), incremental=False))
    return lake.raw.read().select("source_id", "source_name", F.get_json_object("raw_data", "$.title").alias("title"))
