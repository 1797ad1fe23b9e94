"""Read queries over the unified table, the runs and the drift log."""

from __future__ import annotations

import datetime as dt
import json
import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweave.operators.normalize import public

MAX_PAGE_SIZE = 1000
MAX_RECENT_RUNS = 100
# So many rows can be sorted for a page; a page that lies deeper is located by histograms of so many ranges first.
TOP_ROWS = 100_000
RANGES = 1000


def matching(
    records: DataFrame,
    source_type: str | None = None,
    category: str | None = None,
    canonical_id: str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Equality filters and a case-insensitive search, all optional and all required.

    An empty string counts as not given. ``%`` and ``_`` in the search stay wildcards.
    """
    wanted = {"source_type": source_type, "category": category, "canonical_id": canonical_id}
    for column, value in wanted.items():
        if value:
            records = records.filter(F.col(column) == value)
    if search:
        # A backslash escapes wildcards and itself; before anything else it means nothing.
        pattern = "%" + re.sub(r"\\(?![%_\\]|$)", "", search) + "%"
        records = records.filter(
            F.col("title").ilike(pattern) | F.col("description").ilike(pattern)
        )
    return records


def _check_page(page: int, page_size: int) -> None:
    if page < 1:
        raise ValueError("page starts at 1")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")


def _newest_first() -> list[Column]:
    return [F.col("created_at").desc_nulls_last(), F.col("source_id").asc()]


def page_of(records: DataFrame, page: int = 1, page_size: int = 50) -> DataFrame:
    """One page, newest first, ties by source_id."""
    _check_page(page, page_size)
    offset = (page - 1) * page_size
    if offset + page_size <= TOP_ROWS:
        return public(records.orderBy(*_newest_first()).offset(offset).limit(page_size))
    return public(deep_page(records, offset, page_size))


def deep_page(records: DataFrame, offset: int, page_size: int) -> DataFrame:
    """A page far down: found by histograms of the sort keys, then read by a filter on them.

    Each histogram counts the rows of what is left in a thousand equal ranges of a key, first of created_at, then of the next
    bytes of source_id, and leaves the ranges the page lies in, until ``TOP_ROWS`` rows are left or all keys in them are equal.
    Only counts come to the driver, only keys are read for them, and nothing is written.
    """
    within, before = _seek(records, offset, page_size)
    if within is None:
        return records.limit(0)
    return records.filter(within).orderBy(*_newest_first()).offset(offset - before).limit(page_size)


def _seek(records: DataFrame, offset: int, page_size: int) -> tuple[Column | None, int]:
    """A condition on the sort keys that holds for the rows of a page and few others, and how many rows come before those."""
    # Newest first, nulls last: ascending in this number.
    age = F.coalesce(-F.unix_micros("created_at"), F.lit((1 << 63) - 1))
    within, before, skipped = F.lit(True), 0, None
    while True:
        if skipped is None:
            key = age
        else:
            # Seven bytes of the id after what all ids have in common, as a number.
            key = F.expr(f"cast(conv(hex(rpad(substring(cast(source_id AS binary), {skipped + 1}, 7), 7, X'00')), 16, 10) AS bigint)")
        left = records.filter(within)
        low, high, first, last, n = left.agg(F.min(key), F.max(key), F.min("source_id"), F.max("source_id"), F.count("*")).first()
        if before + n <= offset:
            return None, before
        if n <= TOP_ROWS:
            return within, before
        if low == high:
            if skipped is not None and (first is None or first == last):
                return within, before
            skipped = len(os.path.commonprefix([(first or "").encode(), (last or "").encode()]))
            continue
        width = (high - low) // RANGES + 1
        # Differences of decimals: the keys may span more than a 64-bit number.
        whole = "decimal(20,0)"
        place = F.call_function("div", key.cast(whole) - F.lit(low).cast(whole), F.lit(width).cast(whole)).cast("int")
        sizes = sorted(left.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect())
        edges, seen = [], before
        for at, size in sizes:
            if seen < offset + page_size and seen + size > offset:
                edges.append((at, seen))
            seen += size
        start, end = low + edges[0][0] * width, min(low + (edges[-1][0] + 1) * width - 1, high)
        before, within = edges[0][1], within & key.between(start, end)
        if len(edges) > 1:
            return within, before


def page_info(
    records: DataFrame, page: int = 1, page_size: int = 50, filters: dict[str, str] | None = None
) -> DataFrame:
    """What goes with a page of ``records``; ``filters`` are the ones applied to them, shown as JSON."""
    _check_page(page, page_size)
    applied = {k: v for k, v in (filters or {}).items() if v}
    total = records.agg(F.count("*").alias("total_records"))
    return total.select(
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        "total_records",
        F.ceil(F.col("total_records") / page_size).cast("long").alias("total_pages"),
        F.lit(json.dumps(applied) if applied else None).cast("string").alias("filters_applied"),
    )


def entity_records(records: DataFrame, canonical_id: str) -> DataFrame:
    """Every record of one entity, by source, newest first in each."""
    return records.filter(F.col("canonical_id") == canonical_id).orderBy(
        "source_type", *_newest_first()
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise LookupError(f"no records found for {what}")
    return df


def entity_history(records: DataFrame, canonical_id: str) -> DataFrame:
    return records.filter(F.col("canonical_id") == canonical_id).orderBy("created_at", "source_id")


def entity_by_freshness(records: DataFrame, canonical_id: str) -> DataFrame:
    return records.filter(F.col("canonical_id") == canonical_id).orderBy(
        F.col("source_timestamp").desc_nulls_last(), "source_id"
    )


def recent_records(records: DataFrame, source_type: str, since: dt.datetime | str) -> DataFrame:
    cutoff = F.lit(since).cast("timestamp")
    return records.filter(
        (F.col("source_type") == source_type) & (F.col("created_at") >= cutoff)
    ).orderBy(*_newest_first())


def failed_runs(runs: DataFrame, since: dt.datetime | str) -> DataFrame:
    cutoff = F.lit(since).cast("timestamp")
    return runs.filter(
        (F.col("status") == "failure") & (F.col("started_at") >= cutoff)
    ).orderBy(F.col("started_at").desc(), "run_id")


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    if not 1 <= limit <= MAX_RECENT_RUNS:
        raise ValueError(f"limit must be between 1 and {MAX_RECENT_RUNS}")
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(limit)


def latest_drift(log: DataFrame, limit: int = 10) -> DataFrame:
    return log.orderBy(F.col("detected_at").desc(), "source_name", "record_id").limit(limit)


def health(checkpoints: DataFrame) -> DataFrame:
    """The source that succeeded last: when, and its status now; ``unknown`` without any."""
    latest = checkpoints.agg(
        F.max_by(
            F.struct("last_success_at", "status"),
            F.struct("last_success_at", "source_type"),
        ).alias("latest")
    )
    return latest.select(
        F.col("latest.last_success_at").alias("etl_last_run"),
        F.coalesce("latest.status", F.lit("unknown")).alias("etl_status"),
    )
