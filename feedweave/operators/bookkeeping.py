"""Checkpoints and run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.schemas import CHECKPOINT_UPDATES, CHECKPOINTS, RUNS

RESUMABLE = ["failure", "running"]


def _last(column: str, given: Column) -> Column:
    """Latest value of a column among the updates that give one."""
    return F.max_by(F.when(given, F.col(column)), F.when(given, F.col("seq")))


def merge_checkpoints(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply any number of ordered updates per source (``CHECKPOINT_UPDATES`` rows).

    Status is replaced, records_processed accumulates, id, timestamp and metadata change only
    when given. Success stamps last_success_at and clears the error; failure stamps
    last_failure_at and sets it; a running update leaves both alone.
    """
    done = F.col("status").isin("success", "failure")
    folded = updates.groupBy("source_type").agg(
        F.max_by("status", "seq").alias("n_status"),
        F.sum("records_processed").alias("n_processed"),
        _last("last_processed_id", F.coalesce(F.length("last_processed_id") > 0, F.lit(False))).alias("n_id"),
        _last("last_processed_timestamp", F.col("last_processed_timestamp").isNotNull()).alias("n_ts"),
        _last("extra_metadata", F.coalesce(F.size("extra_metadata") > 0, F.lit(False))).alias("n_meta"),
        F.max(F.when(F.col("status") == "success", F.col("at"))).alias("n_success"),
        F.max(F.when(F.col("status") == "failure", F.col("at"))).alias("n_failure"),
        _last("status", done).alias("n_end"),
        F.max_by(
            F.when(done, F.struct("error_message")), F.when(done, F.col("seq"))
        ).alias("n_error"),
    )
    merged = current.join(folded, "source_type", "full_outer")
    no_meta = F.create_map().cast(CHECKPOINTS["extra_metadata"].dataType)
    values = {
        "source_type": F.col("source_type"),
        "last_processed_id": F.coalesce("n_id", "last_processed_id"),
        "last_processed_timestamp": F.coalesce("n_ts", "last_processed_timestamp"),
        "last_success_at": F.coalesce("n_success", "last_success_at"),
        "last_failure_at": F.coalesce("n_failure", "last_failure_at"),
        "records_processed": F.coalesce("records_processed", F.lit(0))
        + F.coalesce("n_processed", F.lit(0)),
        "status": F.coalesce("n_status", "status"),
        "error_message": F.when(F.col("n_end") == "failure", F.col("n_error.error_message"))
        .when(F.col("n_end") == "success", F.lit(None))
        .otherwise(F.col("error_message")),
        "extra_metadata": F.coalesce("n_meta", "extra_metadata", no_meta),
    }
    return merged.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in CHECKPOINTS.fields]
    )


def runs_from_events(events: DataFrame, order: str = "at") -> DataFrame:
    """Run history: one row per run from its start and completion events.

    Counters, status and error come from the latest completion by ``order``; a run without one is still running.
    """
    ended = F.col("status") != "running"

    def at_end(column: str) -> Column:
        return F.max_by(F.when(ended, F.col(column)), F.when(ended, F.col(order)))

    def at_start(column: str) -> Column:
        return F.min_by(F.when(~ended, F.col(column)), F.when(~ended, F.col(order)))

    counters = [f for f in RUNS.fieldNames() if f.startswith("records_")]
    grouped = events.groupBy("run_id").agg(
        F.max("source_type").alias("source_type"),
        F.min("at").alias("started_at"),
        at_end("at").alias("completed_at"),
        *[F.coalesce(at_end(c), F.lit(0)).alias(c) for c in counters],
        F.coalesce(at_end("status"), F.lit("running")).alias("status"),
        at_end("error_message").alias("error_message"),
        at_start("extra_metadata").alias("extra_metadata"),
    )
    timed = grouped.withColumn(
        "duration_seconds", S.elapsed_seconds(F.col("started_at"), F.col("completed_at"))
    )
    return timed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUNS.fields])


def checkpoints_from_events(events: DataFrame) -> DataFrame:
    """Checkpoints of all sources from the log of a lake's runs (``LOG_EVENTS`` rows, ordered by ``seq``)."""
    updates = events.select(*[F.col(f.name) for f in CHECKPOINT_UPDATES.fields])
    return merge_checkpoints(no_checkpoints(events.sparkSession), updates)


def no_checkpoints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHECKPOINTS)


def checkpoint_updates(
    run_events: DataFrame, last_id: Column | None = None, last_timestamp: Column | None = None
) -> DataFrame:
    """What run events mean for the checkpoints of their sources; an end sorts after a start."""
    ended = (F.col("status") != "running").cast("int")
    return run_events.select(
        "source_type",
        (F.unix_micros(F.col("at").cast("timestamp")) * 2 + ended).alias("seq"),
        "at",
        "status",
        F.coalesce("records_processed", F.lit(0)).alias("records_processed"),
        (S.null_text() if last_id is None else last_id).alias("last_processed_id"),
        (F.lit(None) if last_timestamp is None else last_timestamp)
        .cast("timestamp")
        .alias("last_processed_timestamp"),
        "error_message",
        "extra_metadata",
    )


def after_high_water(df: DataFrame, checkpoints: DataFrame, timestamp: str = "source_timestamp") -> DataFrame:
    """Rows not yet processed: later than their source's high-water mark.

    Rows without a timestamp, and sources without a mark, always pass.
    """
    marks = checkpoints.select("source_type", F.col("last_processed_timestamp").alias("_mark"))
    fresh = F.col("_mark").isNull() | F.col(timestamp).isNull() | (F.col(timestamp) > F.col("_mark"))
    return df.join(marks, "source_type", "left").filter(fresh).drop("_mark")


def high_water(checkpoints: DataFrame, source_type: str):
    """The mark of one source as a Python value, so a scan can push the comparison down."""
    row = (
        checkpoints.filter(F.col("source_type") == source_type)
        .select("last_processed_timestamp")
        .first()
    )
    return row[0] if row else None


def to_resume(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.filter(F.col("status").isin(RESUMABLE)).select("source_type", "status")


def should_resume(checkpoints: DataFrame, source_type: str) -> bool:
    return not to_resume(checkpoints).filter(F.col("source_type") == source_type).isEmpty()
