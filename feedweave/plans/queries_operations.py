"""Runs, checkpoints, metrics and call rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave.operators import bookkeeping as B
from feedweave.operators import metrics as X
from feedweave.operators import reads
from feedweave.operators.metrics import error_rates
from feedweave.operators.normalize import unify
from feedweave.plans import sql
from feedweave.plans import tables as t
from feedweave.plans.catalog import query

_RUN = f"""run_id, source_type, {sql.stamp('started_at')} AS started_at, {sql.stamp('completed_at')} AS completed_at,
round(duration_seconds, 6) AS duration_seconds, records_processed, records_inserted, records_updated, records_failed,
status, error_message, label AS day"""


def _runs(df):
    return df.select(
        "run_id", "source_type", t.text_of("started_at").alias("started_at"), t.text_of("completed_at").alias("completed_at"),
        F.round("duration_seconds", 6).alias("duration_seconds"), "records_processed", "records_inserted",
        "records_updated", "records_failed", "status", "error_message", F.col("extra_metadata")["day"].alias("day"),
    )


@query(f"WITH {sql.RUNS} SELECT {_RUN} FROM runs")
def run_history(spark, folder):
    return _runs(t.runs(spark, folder))


@query(f"WITH {sql.RUNS} SELECT {_RUN} FROM runs ORDER BY started_at DESC, run_id LIMIT 10")
def recent_runs(spark, folder):
    return _runs(reads.recent_runs(t.runs(spark, folder), 10))


@query(f"""WITH {sql.RUNS} SELECT {_RUN} FROM runs WHERE status = 'failure' AND runs.started_at >= TIMESTAMP '2024-01-20'
ORDER BY runs.started_at DESC, run_id""")
def failed_runs_recent(spark, folder):
    return _runs(reads.failed_runs(t.runs(spark, folder), "2024-01-20 00:00:00"))


@query(f"""WITH {sql.RUNS} SELECT source_type, count(*) AS total, count(*) FILTER (status = 'success') AS success,
count(*) FILTER (status = 'failure') AS failure, round(count(*) FILTER (status = 'success') / count(*), 6) AS success_rate
FROM runs GROUP BY 1""")
def runs_by_source(spark, folder):
    return X.runs_by_source(t.runs(spark, folder))


@query(f"WITH {sql.RUNS} SELECT source_type, status, count(*) AS runs FROM runs GROUP BY 1, 2")
def run_status_totals(spark, folder):
    return X.runs_by_status(t.runs(spark, folder))


@query(f"""WITH {sql.RUNS} SELECT source_type, sum(records_processed)::BIGINT AS processed,
sum(records_inserted)::BIGINT AS inserted, sum(records_failed)::BIGINT AS failed FROM runs GROUP BY 1""")
def run_counters(spark, folder):
    return X.counters_by_source(t.runs(spark, folder))


@query(f"""WITH {sql.RUNS}, totals AS (SELECT source_type, sum(records_processed)::BIGINT AS processed,
sum(records_failed)::BIGINT AS failed FROM runs GROUP BY 1)
SELECT source_type, processed, failed, round(failed / (processed + failed), 6) AS error_rate FROM totals
WHERE failed / (processed + failed) > 0.05""")
def error_rate_alert(spark, folder):
    return error_rates(t.runs(spark, folder)).withColumn("error_rate", F.round("error_rate", 6))


_HOURS = [21, 22, 23, 23.5]


@query(f"""WITH {sql.RUNS}, bounds(le, bound) AS (VALUES {', '.join(f"('{h * 3600:g}', {h * 3600})" for h in _HOURS)}, ('+Inf', NULL))
SELECT source_type, le, count(*) FILTER (duration_seconds IS NOT NULL AND (bound IS NULL OR duration_seconds <= bound)) AS bucket_count,
round(sum(duration_seconds), 3) AS duration_sum, count(duration_seconds) AS duration_count
FROM runs CROSS JOIN bounds GROUP BY source_type, le""")
def run_histogram(spark, folder):
    counted = X.duration_histogram(t.runs(spark, folder), [h * 3600 for h in _HOURS])
    return counted.withColumn("duration_sum", F.round("duration_sum", 3))


_POINT = f"""source_type, last_processed_id, {sql.stamp('last_processed_timestamp')} AS last_processed_timestamp,
{sql.stamp('last_success_at')} AS last_success_at, {sql.stamp('last_failure_at')} AS last_failure_at,
records_processed, status, error_message, label AS day"""


def _points(df):
    stamps = ["last_processed_timestamp", "last_success_at", "last_failure_at"]
    return df.select(
        "source_type", "last_processed_id", *[t.text_of(c).alias(c) for c in stamps], "records_processed",
        "status", "error_message", F.col("extra_metadata")["day"].alias("day"),
    )


@query(f"WITH {sql.CHECKPOINTS} SELECT {_POINT} FROM checkpoints")
def checkpoint_merge(spark, folder):
    """Two rounds of updates: the second finds the rows of the first."""
    updates = t.checkpoint_updates(spark, folder)
    cut = F.lit("2024-01-16").cast("timestamp")
    first = B.merge_checkpoints(B.no_checkpoints(spark), updates.filter(F.col("at") < cut))
    return _points(B.merge_checkpoints(first, updates.filter(F.col("at") >= cut)))


@query(f"WITH {sql.CHECKPOINTS} SELECT source_type, status FROM checkpoints WHERE status IN ('failure', 'running')")
def resume_sources(spark, folder):
    return B.to_resume(t.checkpoints(spark, folder))


@query(f"""WITH {sql.CHECKPOINTS} SELECT {sql.stamp('last_success_at')} AS etl_last_run, status AS etl_status
FROM checkpoints ORDER BY checkpoints.last_success_at DESC NULLS LAST, source_type DESC LIMIT 1""")
def health(spark, folder):
    return reads.health(t.checkpoints(spark, folder)).withColumn("etl_last_run", t.text_of("etl_last_run"))


@query(f"""WITH {sql.CHECKPOINTS}, {sql.FEEDS} SELECT
((SELECT count(*) FROM csv_feed) + (SELECT count(*) FROM api1_feed))::BIGINT AS total_records_normalized,
sum(records_processed)::BIGINT AS total_records_processed, count(*) FILTER (status = 'success') AS successful_sources,
count(*) FILTER (status = 'failure') AS failed_sources, count(*) AS total_sources FROM checkpoints""")
def stats_summary(spark, folder):
    records = unify([t.order_records(spark, folder), t.event_records(spark, folder)])
    return X.summary(records, t.checkpoints(spark, folder))


@query(f"""WITH {sql.FEEDS}, feeds AS (SELECT source_type FROM csv_feed UNION ALL SELECT source_type FROM api1_feed
UNION ALL SELECT source_type FROM api2_feed UNION ALL SELECT source_type FROM rss_feed)
SELECT source_type, count(*) AS records FROM feeds GROUP BY 1""")
def records_by_source(spark, folder):
    return X.records_by_source(unify([f(spark, folder) for f in (t.orders, t.events, t.parts, t.pages)]))


def _iso(column):
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


@query(f"""WITH {sql.CHECKPOINTS}, {sql.FEEDS}, {sql.DRIFT},
r AS (SELECT source_type AS k, json_object('total', count(*), 'success', count(*) FILTER (status = 'success'),
      'failure', count(*) FILTER (status = 'failure'))::VARCHAR AS v FROM runs GROUP BY 1),
n AS (SELECT source_type AS k, count(*)::VARCHAR AS v FROM (SELECT source_type FROM csv_feed UNION ALL SELECT source_type FROM api1_feed) GROUP BY 1),
d AS (SELECT event_type AS k, count(*)::VARCHAR AS v FROM scored WHERE has_drift GROUP BY 1),
c AS (SELECT source_type AS k, json_object('status', status, 'last_success', {_iso('last_success_at')},
      'records_processed', records_processed)::VARCHAR AS v FROM checkpoints)
SELECT '{{"timestamp":"2024-06-01T00:00:00.000000+00:00","runs":{{' || (SELECT string_agg('"' || k || '":' || v, ',' ORDER BY k) FROM r)
|| '}},"records":{{' || (SELECT string_agg('"' || k || '":' || v, ',' ORDER BY k) FROM n)
|| '}},"schema_drift":{{' || (SELECT string_agg('"' || k || '":' || v, ',' ORDER BY k) FROM d)
|| '}},"checkpoints":{{' || (SELECT string_agg('"' || k || '":' || v, ',' ORDER BY k) FROM c) || '}}}}' AS metrics""")
def metrics_document(spark, folder):
    records = unify([t.order_records(spark, folder), t.event_records(spark, folder)])
    return X.document(
        t.runs(spark, folder), records, t.drift_log(spark, folder), t.checkpoints(spark, folder), t.as_of()
    )


@query(f"""WITH {sql.RUNS}, {sql.DRIFT}
SELECT json_object('timestamp', {_iso('started_at')}, 'level', 'INFO', 'event', 'etl_run_started', 'source_type', source_type, 'run_id', run_id)::VARCHAR AS value FROM runs
UNION ALL SELECT json_object('timestamp', {_iso('completed_at')}, 'level', 'INFO', 'event', 'etl_run_completed', 'source_type', source_type,
  'run_id', run_id, 'duration_seconds', duration_seconds, 'records_processed', records_processed, 'status', status)::VARCHAR FROM runs WHERE status = 'success'
UNION ALL SELECT json_object('timestamp', {_iso('completed_at')}, 'level', 'ERROR', 'event', 'etl_run_failed', 'source_type', source_type,
  'run_id', run_id, 'error', error_message)::VARCHAR FROM runs WHERE status = 'failure'
UNION ALL SELECT json_object('timestamp', {_iso('ts')}, 'level', 'WARNING', 'event', 'schema_drift_detected', 'source_name', event_type,
  'record_id', event_id::VARCHAR, 'confidence_score', confidence, 'missing_fields', missing, 'extra_fields', extra)::VARCHAR FROM scored WHERE has_drift""")
def event_log(spark, folder):
    return X.event_log(t.runs(spark, folder), t.drift_log(spark, folder))


def _calls(spark, folder):
    return t.table(spark, folder, "events").select("event_type", "ts")


_WINDOW = """counted AS (SELECT event_type AS source, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
  RANGE BETWEEN INTERVAL '3599.999999' SECOND PRECEDING AND CURRENT ROW) AS in_window FROM events)"""


@query(f"""WITH {_WINDOW} SELECT source, {sql.stamp('ts')} AS ts, count(*) AS calls, max(in_window) AS in_window
FROM counted GROUP BY source, counted.ts""")
def rate_window(spark, folder):
    counted = X.trailing_calls(_calls(spark, folder), "event_type", "ts", period_seconds=3600)
    return counted.withColumn("ts", t.text_of("ts"))


@query(f"""WITH {_WINDOW} SELECT source, count(*) AS calls, max(in_window) AS peak_calls,
count(*) FILTER (in_window > 5) AS violations FROM counted GROUP BY source""")
def rate_report(spark, folder):
    return X.rate_report(_calls(spark, folder), "event_type", "ts", limit=5, period_seconds=3600)


_MIDDLE = "make_timestamp((epoch_us(min(source_timestamp)) + epoch_us(max(source_timestamp))) // 2)"


@query(f"""WITH {sql.FEEDS},
feeds AS (SELECT source_type, source_id, source_timestamp FROM csv_feed UNION ALL SELECT source_type, source_id, source_timestamp FROM api1_feed
          UNION ALL SELECT source_type, source_id, source_timestamp FROM api2_feed),
marks AS (SELECT source_type, {_MIDDLE} AS mark FROM feeds WHERE source_type <> 'api2' GROUP BY 1)
SELECT source_type, source_id, {sql.stamp('source_timestamp')} AS source_timestamp FROM feeds LEFT JOIN marks USING (source_type)
WHERE mark IS NULL OR feeds.source_timestamp IS NULL OR feeds.source_timestamp > mark""")
def hwm_filter(spark, folder):
    """Rows later than a mark half way through each source."""
    feeds = unify([f(spark, folder) for f in (t.orders, t.events, t.parts)]).select(
        "source_type", "source_id", "source_timestamp"
    )
    ends = F.unix_micros(F.min("source_timestamp")) + F.unix_micros(F.max("source_timestamp"))
    marks = feeds.filter("source_type <> 'api2'").groupBy("source_type").agg(
        F.timestamp_micros(F.floor(ends / 2)).alias("last_processed_timestamp")
    )
    fresh = B.after_high_water(feeds, marks)
    return fresh.select("source_type", "source_id", t.text_of("source_timestamp").alias("source_timestamp"))
