"""Feed files written from the tables and read back, stored tables and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedweave.functions.scalars import null_text
from feedweave.operators.normalize import ALIAS_FIELDS, parse_csv
from feedweave.plans import ingest, sql
from feedweave.plans import tables as t
from feedweave.plans.catalog import query
from feedweave.session import fresh_dir
from feedweave.sources import archive, files
from feedweave.streaming import incremental

PAGE_OF_RESPONSES = 100


@query("""SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS title, o_totalprice AS value, o_orderstatus AS category,
strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS timestamp FROM orders""")
def scan_csv(spark, folder):
    path = fresh_dir(spark, "csv")
    t.order_rows(spark, folder).write.option("header", True).csv(path)
    rows = files.read_csv(spark, path)
    return rows.select("id", "title", F.col("value").cast("double").alias("value"), "category", "timestamp")


@query(r"""SELECT doc_id::VARCHAR AS id, md5(regexp_replace(text, '\r\n?', chr(10), 'g')) AS description_md5, lang AS category FROM documents""")
def scan_csv_multiline(spark, folder):
    """Cells with quotes and line breaks."""
    path = fresh_dir(spark, "csv")
    rows = t.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.lit("t").alias("title"), F.col("text").alias("description"),
        F.lit("1").alias("value"), F.col("lang").alias("category"),
    )
    keep = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**keep).csv(path)
    return files.read_csv(spark, path, rows.columns, multiline=True).select(
        "id", F.md5("description").alias("description_md5"), "category"
    )


def _responses(df):
    """API responses of up to a hundred records, in each of the shapes a provider may use.

    Records are grouped by their position in the scan, so no response grows with a key.
    """
    place = F.monotonically_increasing_id()
    numbered = df.select("raw_data", F.floor(place / PAGE_OF_RESPONSES).alias("response"))
    lists = numbered.groupBy("response").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("raw_data"), ","), F.lit("]")).alias("body")
    )
    shape = F.col("response") % 3
    return lists.select(
        F.when(shape == 0, F.col("body"))
        .when(shape == 1, F.concat(F.lit('{"data":'), F.col("body"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"results":'), F.col("body"), F.lit("}")))
        .alias("value")
    )


@query(f"""SELECT 'api_api1_' || event_id AS source_id, event_type AS title, value, {sql.stamp('ts')} AS source_timestamp FROM events
UNION ALL SELECT 'api_api1_' || p_partkey, p_name, p_retailprice, NULL FROM part""")
def scan_json_payload(spark, folder):
    """Events in listed responses, parts as one object per response."""
    path = fresh_dir(spark, "json")
    listed = _responses(t.event_json(spark, folder))
    single = t.part_json(spark, folder).select(F.col("raw_data").alias("value"))
    listed.unionByName(single).write.text(path)
    parsed = t.parse_api(files.read_json_payloads(spark, path), "api1")
    return parsed.select("source_id", "title", "value", t.text_of("source_timestamp").alias("source_timestamp"))


def _xml(df, row_tag, root_tag, path):
    df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


@query(f"""SELECT 'rss_' || url AS source_id, trim({sql.PAGE_TITLE}, '{sql.SPACE_CHARS}') AS title,
{sql.LANGUAGE} AS category, url AS link, '2024-01-15 10:30:00.000000' AS published, md5(trim(html, '{sql.SPACE_CHARS}')) AS summary_md5 FROM pages""")
def scan_rss(spark, folder):
    path = fresh_dir(spark, "rss")
    entries = t.page_entries(spark, folder)
    items = entries.select(
        "title", "link", F.col("summary").alias("description"),
        F.struct(F.col("link").alias("_VALUE"), F.lit("true").alias("_isPermaLink")).alias("guid"),
        F.lit("Mon, 15 Jan 2024 10:30:00 GMT").alias("pubDate"), F.col("categories").alias("category"),
    )
    _xml(items, "item", "channel", path)
    parsed = t.parse_rss(files.read_rss(spark, path))
    return parsed.select(
        "source_id", "title", "category", F.col("extra_metadata")["link"].alias("link"),
        t.text_of("source_timestamp").alias("published"), F.md5("description").alias("summary_md5"),
    )


@query(f"""SELECT 'rss_' || url AS source_id, trim({sql.PAGE_TITLE}, '{sql.SPACE_CHARS}') AS title,
{sql.LANGUAGE} || ',page' AS tags, url AS link FROM pages""")
def scan_atom(spark, folder):
    path = fresh_dir(spark, "atom")
    entries = t.page_entries(spark, folder)
    terms = F.transform(F.concat("categories", F.array(F.lit("page"))), lambda c: F.struct(c.alias("_term")))
    href = F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel"))
    atom = entries.select(
        "title", F.array(href).alias("link"), F.lit("2024-01-15T10:30:00Z").alias("updated"), terms.alias("category")
    )
    _xml(atom, "entry", "feed", path)
    parsed = t.parse_rss(files.read_atom(spark, path))
    return parsed.select(
        "source_id", "title", F.array_join("tags", ",").alias("tags"), F.col("extra_metadata")["link"].alias("link")
    )


def _lake(spark, name):
    at = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
    return ingest.Lake(spark, fresh_dir(spark, name), clock=lambda: at)


@query("""SELECT 'csv_' || o_orderkey AS source_id, o_totalprice AS value, o_orderpriority AS title FROM orders""")
def store_roundtrip(spark, folder):
    """Write the unified table twice, and read the current state of both runs."""
    lake = _lake(spark, "store")
    rows = t.order_records(spark, folder)
    lake.change(rows.withColumn("title", F.lit("first")))
    lake.change(rows)
    return lake.records.read().select("source_id", "value", "title")


@query("""SELECT 'csv_' || o_orderkey AS source_id, o_orderstatus AS category, o_totalprice AS value, 'update' AS change FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL SELECT 'csv_' || o_orderkey, o_orderstatus, o_totalprice, 'none' FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""")
def ingest_twice(spark, folder):
    """A full run, then a run over the later rows again: same keys, later rows updated."""
    lake = _lake(spark, "ingest")
    for rows in (t.orders(spark, folder),
                 t.orders(spark, folder).filter(F.col("source_timestamp") >= F.lit("1998-01-01").cast("timestamp"))):
        result = lake.run(ingest.csv_rows_feed(lambda rows=rows: rows), incremental=False)
        if result.status != "success":
            raise RuntimeError(result.error)
    change = F.when(F.col("updated_at").isNull(), "none").otherwise("update")
    return lake.records.read().select("source_id", "category", "value", change.alias("change"))


@query(f"""WITH {sql.FEEDS} SELECT source_type, source_id, title, category, value FROM csv_feed
UNION ALL SELECT source_type, source_id, title, category, value FROM api1_feed
UNION ALL SELECT source_type, source_id, title, category, NULL FROM rss_feed""")
def renormalize_raw(spark, folder):
    """Records rebuilt from their archived raw text alone."""
    feeds = {"csv": t.orders, "api1": t.events, "rss": t.pages}
    raw = None
    for name, feed in feeds.items():
        rows = feed(spark, folder).select("source_type", "source_id", F.lit(name).alias("source_name"), "raw_data")
        raw = rows if raw is None else raw.unionByName(rows)
    again = [archive.archived_csv(raw), archive.archived_api(raw, "api1"), archive.archived_rss(raw)]
    columns = ["source_type", "source_id", "title", "category", "value"]
    return again[0].select(*columns).unionByName(again[1].select(*columns)).unionByName(again[2].select(*columns))


def _event_stream(spark, folder, label):
    """Events landed as several files and read back as a stream of a few batches."""
    path = fresh_dir(spark, label)
    landed = t.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"),
        null_text().alias("description"), F.col("value").cast("string").alias("value"),
        F.col("event_type").alias("category"), F.col("ts").cast("string").alias("timestamp"),
    )
    landed.repartition(4).write.parquet(path)
    schema = spark.read.parquet(path).schema
    return incremental.stream_files(spark, path, schema, maxFilesPerTrigger="2")


@query(f"""SELECT 'csv_' || event_id AS source_id, event_type AS title, value, {sql.stamp('ts')} AS source_timestamp FROM events""")
def stream_incremental(spark, folder):
    lake = _lake(spark, "stream")
    stream = _event_stream(spark, folder, "landing")
    feed = ingest.csv_rows_feed(lambda: None)
    query = incremental.into_lake(
        stream, lake, feed, parse_csv, f"{lake.root}/progress", f"events-{lake.root[-8:]}"
    )
    query.awaitTermination()
    return lake.records.read().select(
        "source_id", "title", "value", t.text_of("source_timestamp").alias("source_timestamp")
    )


@query("""SELECT title, count(*) AS rows FROM (SELECT DISTINCT event_type || '-' || user_id AS source_id, event_type AS title FROM events) GROUP BY 1""")
def stream_dedup(spark, folder):
    """One row per event type and user, whichever batch it came in."""
    landing = fresh_dir(spark, "landing")
    keyed = t.table(spark, folder, "events").select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("source_id"),
        F.col("event_type").alias("title"),
    )
    keyed.repartition(4).write.parquet(landing)
    out = fresh_dir(spark, "dedup")
    stream = incremental.stream_files(spark, landing, keyed.schema, maxFilesPerTrigger="2")
    incremental.distinct_into(stream, out, fresh_dir(spark, "progress")).awaitTermination()
    return spark.read.schema(keyed.schema).parquet(out).groupBy("title").agg(F.count("*").alias("rows"))
