"""Last-record-wins and upserts by natural key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.schemas import RAW_RECORDS, RECORDS
from feedweave.session import stage

# What an update replaces; the other columns stay as first inserted.
UPDATED_COLUMNS = [
    "canonical_id", "title", "description", "value", "category", "tags", "source_timestamp",
    "extra_metadata",
]


def last_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row per key. ``order`` should be total, so that reruns agree.

    Rank-and-keep-first lets Spark drop losers before the shuffle, so a key with very many
    copies sends one row per map task.
    """
    latest = Window.partitionBy(*key).orderBy(*[o.desc_nulls_last() for o in order])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def latest(rows: DataFrame, key: str, place: str, folder: str | None = None) -> DataFrame:
    """The last row per key of staged rows; no two rows share a ``place``, a null key is a key.

    As ``last_wins``, but only keys and places are grouped: the rows are not sorted, however many a task has. Keys
    that repeat are written first, so that their number is known when the join that drops their losers is planned.
    """
    ends = rows.groupBy(F.col(key).alias("_key")).agg(F.max(place).alias("_last"), F.count("*").alias("_copies"))
    repeated = stage(ends.filter("_copies > 1").select("_key", "_last"), "repeated", folder)
    met = rows.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.filter(F.col("_last").isNull() | (F.col(place) == F.col("_last"))).select(*rows.columns)


def new_keys(incoming: DataFrame, existing: DataFrame, key: str = "source_id") -> DataFrame:
    return incoming.join(existing.select(key), key, "left_anti")


def known_keys(incoming: DataFrame, existing: DataFrame, key: str = "source_id") -> DataFrame:
    return incoming.join(existing.select(key), key, "left_semi")


def merged_rows(
    key: str, replaced: Sequence[str], first: Sequence[str], columns: Sequence[str]
) -> Callable[[DataFrame], DataFrame]:
    """How rows of several runs (with ``seq``, the run's place, and ``stamp``) become current rows.

    ``replaced`` columns are as the latest run has them, nulls included, ``first`` ones as the earliest. Once a second run
    has brought a key, ``updated_at`` (if there) is the latest run's stamp. The result carries ``seq`` and ``stamp`` on, so it
    can be merged again, and ``again``. A key that very many runs bring sends one row from each task.
    """
    stamped = "updated_at" in columns

    def merge(rows: DataFrame) -> DataFrame:
        latest = [*replaced, "stamp", *(["updated_at"] if stamped else [])]
        grouped = rows.groupBy(key).agg(
            F.max_by(F.struct(*latest), "seq").alias("new"), F.min_by(F.struct(*first), "seq").alias("old"),
            F.max("seq").alias("seq"), (F.min("seq") < F.max("seq")).alias("again"))
        values = {c: F.col(f"old.{c}") for c in first} | {c: F.col(f"new.{c}") for c in latest}
        if stamped:
            values["updated_at"] = values["stamp"] = F.when(F.col("again"), F.col("new.stamp")).otherwise(F.col("new.updated_at"))
        return grouped.select(*[values.get(c, F.col(c)).alias(c) for c in (*columns, "seq", "stamp")], "again")

    return merge


current_records = merged_rows("source_id", UPDATED_COLUMNS, ["source_type", "created_at"], RECORDS.fieldNames())
current_raw = merged_rows("source_id", ["raw_data"], ["source_type", "source_name", "ingested_at"], RAW_RECORDS.fieldNames())


def _upserted(target: DataFrame, updates: DataFrame, merge: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """Target and updates as two runs, with what became of each key."""
    rows = merge(target.withColumn("seq", F.lit(0)).unionByName(updates.withColumn("seq", F.lit(1))))
    action = F.when(F.col("seq") == 0, "keep").when(F.col("again"), "update").otherwise("insert")
    return rows.select(*columns, action.alias("merge_action"))


def merge_records(target: DataFrame, updates: DataFrame, as_of: Column) -> DataFrame:
    """Upsert unified rows; ``updates`` holds each source_id once (see ``last_wins``).

    A known row takes every updated column from the new side, nulls included, keeps
    created_at and source_type and gets updated_at. The result carries ``merge_action``.
    """
    names, at = RECORDS.fieldNames(), as_of.cast("timestamp")
    old = target.select(*names, F.col("updated_at").alias("stamp"))
    new = updates.select(*names, at.alias("stamp")).withColumn("updated_at", F.lit(None).cast("timestamp"))
    return _upserted(old, new, current_records, names)


def merge_raw(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert of the raw archive: known rows only change raw_data."""
    names, none = RAW_RECORDS.fieldNames(), F.lit(None).cast("timestamp")
    sides = (side.select(*names, none.alias("stamp")) for side in (target, updates))
    return _upserted(*sides, current_raw, names)


def merge_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("source_type").agg(
        F.count_if(F.col("merge_action") == "insert").alias("inserted_keys"),
        F.count_if(F.col("merge_action") == "update").alias("updated_keys"),
        F.count_if(F.col("merge_action") == "keep").alias("kept_keys"),
    )


def ingest_counts(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Counters of one run, equal to upserting row by row.

    ``batch`` has source_type, source_id, ``reasons`` and ``skipped``. The first copy of an
    unknown key counts as inserted, every other accepted row as updated.
    """
    per_key = batch.groupBy("source_type", "source_id").agg(
        F.count_if((F.size("reasons") == 0) & ~F.col("skipped")).alias("accepted"),
        F.count_if(F.size("reasons") > 0).alias("failed"),
        F.count_if((F.size("reasons") == 0) & F.col("skipped")).alias("skipped"),
    )
    known = existing.select("source_id").withColumn("_known", F.lit(True))
    is_new = F.col("_known").isNull() & (F.col("accepted") > 0)
    return (
        per_key.join(known, "source_id", "left")
        .groupBy("source_type")
        .agg(
            F.sum("accepted").alias("records_processed"),
            F.count_if(is_new).alias("records_inserted"),
            (F.sum("accepted") - F.count_if(is_new)).alias("records_updated"),
            F.sum("failed").alias("records_failed"),
            F.sum("skipped").alias("records_skipped"),
        )
    )


def add_columns(old: DataFrame, template: DataFrame) -> DataFrame:
    """Old data with the columns it lacks, as nulls, in the order of the template."""
    empty = template.limit(0)
    return old.unionByName(empty, allowMissingColumns=True).select(*template.columns)
