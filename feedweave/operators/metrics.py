"""Operational metrics from records, runs, checkpoints and the drift log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.session import stage

# Upper bounds of the run-duration histogram, in seconds.
DURATION_BOUNDS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]
ERROR_RATE = 0.05


def records_by_source(records: DataFrame) -> DataFrame:
    return records.groupBy("source_type").agg(F.count("*").alias("records"))


def drift_by_source(log: DataFrame) -> DataFrame:
    return log.groupBy("source_name").agg(F.count("*").alias("events"))


def runs_by_source(runs: DataFrame) -> DataFrame:
    success = F.count_if(F.col("status") == "success")
    return runs.groupBy("source_type").agg(
        F.count("*").alias("total"),
        success.alias("success"),
        F.count_if(F.col("status") == "failure").alias("failure"),
        F.round(success / F.count("*"), 6).alias("success_rate"),
    )


def counters_by_source(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source_type").agg(
        F.sum("records_processed").alias("processed"),
        F.sum("records_inserted").alias("inserted"),
        F.sum("records_failed").alias("failed"),
    )


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source_type", "status").agg(F.count("*").alias("runs"))


def error_rates(runs: DataFrame, threshold: float = ERROR_RATE) -> DataFrame:
    """Sources whose failed share of all handled records is above the threshold."""
    totals = runs.groupBy("source_type").agg(
        F.sum("records_processed").alias("processed"), F.sum("records_failed").alias("failed")
    )
    handled = F.col("processed") + F.col("failed")
    return totals.withColumn("error_rate", F.col("failed") / F.nullif(handled, F.lit(0))).filter(
        F.col("error_rate") > threshold
    )


def duration_histogram(runs: DataFrame, bounds: list[float] | None = None) -> DataFrame:
    """Cumulative bucket counts per source, in long form with a final ``+Inf`` bucket."""
    bounds = DURATION_BOUNDS if bounds is None else bounds
    names = [f"{b:g}" for b in bounds] + ["+Inf"]
    duration = F.col("duration_seconds")
    counts = [F.count_if(duration <= b) for b in bounds] + [F.count(duration)]
    wide = runs.groupBy("source_type").agg(
        F.sum(duration).alias("duration_sum"),
        F.count(duration).alias("duration_count"),
        *[c.alias(n) for n, c in zip(names, counts)],
    )
    return wide.unpivot(
        ["source_type", "duration_sum", "duration_count"], [F.col(f"`{n}`") for n in names], "le", "bucket_count"
    )


def summary(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Totals over all sources in one row."""
    zero = F.lit(0).cast("long")
    counted = records.agg(F.count("*").alias("n")).select(
        F.col("n").alias("normalized"), zero.alias("processed"), zero.alias("ok"),
        zero.alias("bad"), zero.alias("sources"),
    )
    stated = checkpoints.select(
        zero.alias("normalized"),
        F.col("records_processed").alias("processed"),
        (F.col("status") == "success").cast("long").alias("ok"),
        (F.col("status") == "failure").cast("long").alias("bad"),
        F.lit(1).cast("long").alias("sources"),
    )
    return counted.unionByName(stated).agg(
        F.sum("normalized").alias("total_records_normalized"),
        F.sum("processed").alias("total_records_processed"),
        F.sum("ok").alias("successful_sources"),
        F.sum("bad").alias("failed_sources"),
        F.sum("sources").alias("total_sources"),
    )


def iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def document(
    runs: DataFrame, records: DataFrame, drift_log: DataFrame, checkpoints: DataFrame, at: Column
) -> DataFrame:
    """All metrics as one JSON document; every part is grouped by source first."""

    def part(df: DataFrame, section: str, key: str, body: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.col(key).alias("key"), body.alias("body"))

    def as_json(*columns: Column) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    rows = (
        part(runs_by_source(runs), "runs", "source_type", as_json("total", "success", "failure"))
        .unionByName(
            part(records_by_source(records), "records", "source_type", F.col("records").cast("string"))
        )
        .unionByName(
            part(drift_by_source(drift_log), "schema_drift", "source_name", F.col("events").cast("string"))
        )
        .unionByName(
            part(
                checkpoints, "checkpoints", "source_type",
                as_json(
                    F.col("status"), iso(F.col("last_success_at")).alias("last_success"),
                    F.col("records_processed"),
                ),
            )
        )
    )

    def quoted(text: Column) -> Column:
        # A one-element JSON list without its brackets.
        return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")

    def section(name: str) -> Column:
        mine = F.when(F.col("section") == name, F.struct("key", "body"))
        items = F.transform(
            F.array_sort(F.collect_list(mine)),
            lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["body"]),
        )
        return F.concat(F.lit(f'"{name}":{{'), F.array_join(items, ","), F.lit("}"))

    parts = [section(n) for n in ("runs", "records", "schema_drift", "checkpoints")]
    stamp = F.concat(F.lit('{"timestamp":"'), iso(at), F.lit('"'))
    return rows.agg(
        F.concat(F.concat_ws(",", stamp, *parts), F.lit("}")).alias("metrics")
    )


def event_log(runs: DataFrame, drift_log: DataFrame) -> DataFrame:
    """Structured log lines: run started, completed or failed, and drift detected."""

    def line(level: str, event: str, at: Column, *fields: Column) -> Column:
        return F.to_json(
            F.struct(
                iso(at).alias("timestamp"), F.lit(level).alias("level"),
                F.lit(event).alias("event"), *fields,
            )
        )

    started = runs.select(
        line("INFO", "etl_run_started", F.col("started_at"), "source_type", "run_id").alias("value")
    )
    completed = runs.filter(F.col("status") == "success").select(
        line(
            "INFO", "etl_run_completed", F.col("completed_at"), "source_type", "run_id",
            "duration_seconds", "records_processed", "status",
        ).alias("value")
    )
    failed = runs.filter(F.col("status") == "failure").select(
        line(
            "ERROR", "etl_run_failed", F.col("completed_at"), "source_type", "run_id",
            F.col("error_message").alias("error"),
        ).alias("value")
    )
    drifted = drift_log.select(
        line(
            "WARNING", "schema_drift_detected", F.col("detected_at"), "source_name", "record_id",
            "confidence_score", "missing_fields", "extra_fields",
        ).alias("value")
    )
    return started.unionByName(completed).unionByName(failed).unionByName(drifted)


def trailing_calls(calls: DataFrame, source: str, ts: str, period_seconds: int = 60) -> DataFrame:
    """Calls of each source in the period that ends with each call, itself included.

    A call exactly one period old has expired. Calls come in at their moment and leave one period later, so the count is a
    prefix sum over both, and it is taken in a distributed way: what comes and leaves is dealt into ranges of (source, time)
    of equal numbers of rows, each range adds up for itself, and gets what all ranges before it of the same source add up to.
    So a source spreads over as many tasks as its rows fill, be they all of one hour. One row per (source, moment) with
    ``calls`` at that moment and ``in_window``.
    """
    period = period_seconds * 1_000_000
    moments = (
        calls.groupBy(F.col(source).alias("source"), F.col(ts).alias("ts"))
        .agg(F.count("*").alias("calls"))
        .withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    )
    comes = F.struct(F.col("us").alias("at"), F.col("calls").alias("change"))
    leaves = F.struct((F.col("us") + period).alias("at"), (-F.col("calls")).alias("change"))
    changes = moments.withColumn("event", F.explode(F.array(comes, leaves))).select("source", "ts", "event.at", "event.change")
    # Leavers first among what happens at one moment. The ranges are written, so that they stay what they are.
    ranged = changes.repartitionByRange("source", "at", "change").withColumn("range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    order = Window.partitionBy("range", "source").orderBy("at", "change").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each source in each range.
    offsets = ranged.groupBy("source", "range").agg(F.sum("change").alias("total"))
    offsets = offsets.select("source", "range", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    local = ranged.withColumn("here", F.sum("change").over(order)).filter("change > 0")
    joined = local.alias("l").join(offsets.alias("o"), (F.col("l.range") == F.col("o.range")) & F.col("l.source").eqNullSafe(F.col("o.source")))
    return joined.select("l.source", "l.ts", F.col("l.change").alias("calls"), (F.col("l.here") + F.col("o.before")).alias("in_window"))


def rate_report(
    calls: DataFrame, source: str, ts: str, limit: int = 100, period_seconds: int = 60
) -> DataFrame:
    """Per source: calls, the busiest window and the calls made over the limit."""
    counted = trailing_calls(calls, source, ts, period_seconds)
    return counted.groupBy("source").agg(
        F.sum("calls").alias("calls"),
        F.max("in_window").alias("peak_calls"),
        F.coalesce(
            F.sum(F.when(F.col("in_window") > limit, F.col("calls"))), F.lit(0)
        ).alias("violations"),
    )
