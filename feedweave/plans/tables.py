"""The given tables seen as feeds, runs and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.functions.text import url_slug
from feedweave.operators import bookkeeping, drift
from feedweave.operators.normalize import identity, parse_api, parse_csv, parse_rss
from feedweave.schemas import RECORDS
from feedweave.sources.files import as_records

HTML_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
PATH_LANGUAGE = r"^https?://[^/]+/([a-z]{2})/"
AS_OF = "2024-06-01 00:00:00"

# Fields the event records are expected to carry.
EVENT_FIELDS = {"user_id": "int", "event_type": "str", "value": "float"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def text_of(at: Column | str) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as CSV rows: every cell is text."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.col("o_totalprice").cast("string").alias("value"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderdate").cast("string").alias("timestamp"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return parse_csv(order_rows(spark, folder))


def event_json(spark: SparkSession, folder: str) -> DataFrame:
    """Events as API records, one JSON text each."""
    record = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("type"),
        F.col("ts").cast("string").alias("created_at"),
    )
    return table(spark, folder, "events").select(F.to_json(record).alias("raw_data"))


def api_records(df: DataFrame, feed: str) -> DataFrame:
    return parse_api(as_records(df), feed)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return api_records(event_json(spark, folder), "api1")


def part_json(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as records of the second API, which uses the other field names."""
    record = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.col("p_retailprice").alias("value"),
        F.col("p_type").alias("category"),
        F.array("p_type", "p_brand").alias("tags"),
    )
    return table(spark, folder, "part").select(F.to_json(record).alias("raw_data"))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return api_records(part_json(spark, folder), "api2")


def page_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as feed entries; they carry no id of their own."""
    language = url_slug(F.col("url"), PATH_LANGUAGE)
    return table(spark, folder, "pages").select(
        F.lit(None).cast("string").alias("id"),
        F.regexp_extract("html", HTML_TITLE, 1).alias("title"),
        F.col("html").alias("summary"),
        F.col("url").alias("link"),
        F.lit(None).cast("string").alias("published"),
        F.array_compact(F.array(language)).alias("categories"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return parse_rss(page_entries(spark, folder))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as records of a plain text source, named by their language."""
    return table(spark, folder, "documents").select(
        F.lit("text").alias("source_type"),
        F.concat(F.lit("text_"), F.col("doc_id").cast("string")).alias("source_id"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.col("n_chars").cast("double").alias("value"),
        F.col("lang").alias("category"),
        F.array("lang", "source").alias("tags"),
        F.lit(None).cast("timestamp").alias("source_timestamp"),
        F.create_map(F.lit("source_name"), F.col("source")).alias("extra_metadata"),
        identity(id=F.col("doc_id"), symbol=F.col("lang")).alias("identity"),
        S.raw_json("doc_id", "text", "lang", "source").alias("raw_data"),
        F.array(*[F.lit(c) for c in ("doc_id", "text", "lang", "source")]).alias("fields"),
        F.array().cast("array<string>").alias("reasons"),
    )


def _typed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows of the unified table whose columns come straight from typed ones, so that filters on them reach the scan."""
    return rows.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORDS.fields])


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the unified table, created when they happened; entity = event type."""
    id, kind = F.col("event_id").cast("string"), F.col("event_type")
    return _typed(
        table(spark, folder, "events"), source_type=F.lit("api1"), source_id=F.concat(F.lit("api_api1_"), id), canonical_id=kind,
        title=kind, value=F.col("value"), category=kind, tags=F.array(), source_timestamp=F.col("ts"), created_at=F.col("ts"),
        extra_metadata=F.create_map(F.lit("original_id"), id, F.lit("source_name"), F.lit("api1")))


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the unified table, created when they were made; entity = status in small letters."""
    id, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    return _typed(
        table(spark, folder, "orders"), source_type=F.lit("csv"), source_id=F.concat(F.lit("csv_"), id), canonical_id=F.lower(status),
        title=F.col("o_orderpriority"), value=F.col("o_totalprice"), category=status, source_timestamp=F.col("o_orderdate"),
        created_at=F.col("o_orderdate"), extra_metadata=F.create_map(F.lit("original_id"), id))


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """One run per event type and day: its start, and its end unless it is still open.

    Error days, and days with a value above 400, are failures; a day whose last event comes
    in its final ten minutes has not ended.
    """
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    runs = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("source_type"), day.alias("day"))
        .agg(
            F.min(F.col("ts").cast("timestamp")).alias("first"),
            F.max(F.col("ts").cast("timestamp")).alias("last"),
            F.count("*").alias("handled"),
            F.count_distinct("user_id").alias("users"),
            F.count_if(F.col("value") < 10).alias("bad"),
            F.max("value").alias("peak"),
        )
    )
    key = F.concat_ws("|", "source_type", F.date_format("day", "yyyy-MM-dd"))
    failed = (F.col("source_type") == "error") | (F.col("peak") > 400)
    still_open = F.unix_micros("last") - F.unix_micros("day") >= 85_800_000_000
    zero = F.lit(0).cast("long")
    meta = F.create_map(F.lit("day"), F.date_format("day", "yyyy-MM-dd"))
    base = [S.run_id(F.col("first"), key).alias("run_id"), F.col("source_type")]
    start = F.struct(
        F.col("first").alias("at"), F.lit("running").alias("status"),
        *[zero.alias(f"records_{c}") for c in ("processed", "inserted", "updated", "failed")],
        S.null_text().alias("error_message"), meta.alias("extra_metadata"),
    )
    end = F.struct(
        F.col("last").alias("at"), F.when(failed, "failure").otherwise("success").alias("status"),
        (F.col("handled") - F.col("bad")).alias("records_processed"),
        F.least(F.col("users"), F.col("handled") - F.col("bad")).alias("records_inserted"),
        (F.col("handled") - F.col("bad")
         - F.least(F.col("users"), F.col("handled") - F.col("bad"))).alias("records_updated"),
        F.col("bad").alias("records_failed"),
        F.when(failed, F.concat(F.lit("stopped on "), F.date_format("day", "yyyy-MM-dd"))).alias("error_message"),
        meta.alias("extra_metadata"),
    )
    both = F.when(still_open, F.array(start)).otherwise(F.array(start, end))
    return runs.select(*base, F.explode(both).alias("e")).select("run_id", "source_type", "e.*")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return bookkeeping.runs_from_events(run_events(spark, folder))


def checkpoint_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Updates of the runs; a successful end also names the run and moves the mark."""
    happened = run_events(spark, folder)
    good = F.col("status") == "success"
    return bookkeeping.checkpoint_updates(
        happened, F.when(good, F.col("run_id")), F.when(good, F.col("at"))
    )


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    none = bookkeeping.no_checkpoints(spark)
    return bookkeeping.merge_checkpoints(none, checkpoint_updates(spark, folder))


def drifting_json(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw JSON whose fields depend on the event type: a field renamed, added,
    left out or of another type."""
    kind = F.col("event_type")

    def item(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    user = F.col("user_id").cast("string")
    fields = F.array(
        F.when(kind == "view", item("usr_id", user)).otherwise(item("user_id", user)),
        item("event_type", F.concat(F.lit('"'), kind, F.lit('"'))),
        F.when(kind == "error", item("value", F.lit('"unknown"'))).when(
            kind != "click", item("value", F.col("value").cast("string"))
        ),
        F.when(kind == "signup", item("props", F.col("props"))),
    )
    text = F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))
    return table(spark, folder, "events").select(
        "event_id", "ts", "event_type", text.alias("raw_data")
    )


def drift_of_events(spark: SparkSession, folder: str) -> DataFrame:
    raw = drifting_json(spark, folder).withColumn("fields", F.json_object_keys("raw_data"))
    mismatches = drift.json_mismatches(F.col("record"), EVENT_FIELDS)
    return drift.detect(as_records(raw), EVENT_FIELDS, mismatches=mismatches).drop("record")


def drift_log(spark: SparkSession, folder: str) -> DataFrame:
    return drift.log_rows(
        drift_of_events(spark, folder), F.col("event_type"), F.col("event_id").cast("string"), F.col("ts")
    )
