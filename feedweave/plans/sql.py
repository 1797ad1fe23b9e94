"""SQL fragments for the equivalents of the catalogue queries."""

from __future__ import annotations

from collections.abc import Mapping

from feedweave.functions.scalars import SPACE_CHARS, SPACE_CLASS
from feedweave.functions.text import COIN_URL
from feedweave.plans.tables import AS_OF, HTML_TITLE, PATH_LANGUAGE

AT = f"TIMESTAMP '{AS_OF}'"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def key_of(title: str) -> str:
    return f"trim(lower({title}), '{SPACE_CHARS}')"


def slug(title: str) -> str:
    words = rf"regexp_replace(lower({title}), '[^\p{{L}}\p{{N}}_{SPACE_CLASS}-]', '', 'g')"
    dashed = f"regexp_replace({words}, '[{SPACE_CLASS}-]+', '-', 'g')"
    return f"coalesce(nullif(substr(trim({dashed}, '-'), 1, 100), ''), 'unknown')"


def values(name: str, book: Mapping[str, str]) -> str:
    rows = ", ".join(f"({i}, '{a}', '{c}')" for i, (a, c) in enumerate(book.items()))
    return f"{name}(ord, alias, canonical) AS (VALUES {rows})"


def containment(key: str) -> str:
    return (
        f"(SELECT arg_min(a.canonical, a.ord) FROM aliases a "
        f"WHERE contains({key}, a.alias) OR contains(a.alias, {key}))"
    )


def lookup(key: str, names: str = "aliases") -> str:
    return f"(SELECT max(a.canonical) FROM {names} a WHERE a.alias = {key})"


LANGUAGE = f"nullif(regexp_extract(lower(url), '{PATH_LANGUAGE}', 1), '')"
PAGE_TITLE = f"regexp_extract(html, '{HTML_TITLE}', 1)"
COIN = f"nullif(regexp_extract(lower(url), '{COIN_URL}', 1), '')"

# The feeds in the unified shape.
FEEDS = f"""
csv_feed AS (
  SELECT 'csv' AS source_type, 'csv_' || o_orderkey AS source_id, o_orderpriority AS title,
         NULL::VARCHAR AS description, o_totalprice AS value, o_orderstatus AS category,
         NULL::VARCHAR AS tags, o_orderdate AS source_timestamp,
         o_orderkey::VARCHAR AS origin, NULL::VARCHAR AS link
  FROM orders),
api1_feed AS (
  SELECT 'api1' AS source_type, 'api_api1_' || event_id AS source_id, event_type AS title,
         NULL::VARCHAR AS description, value, event_type AS category, '' AS tags,
         ts AS source_timestamp, event_id::VARCHAR AS origin, NULL::VARCHAR AS link
  FROM events),
api2_feed AS (
  SELECT 'api2' AS source_type, 'api_api2_' || p_partkey AS source_id, p_name AS title,
         p_brand AS description, p_retailprice AS value, p_type AS category,
         p_type || ',' || p_brand AS tags, NULL::TIMESTAMP AS source_timestamp,
         p_partkey::VARCHAR AS origin, NULL::VARCHAR AS link
  FROM part),
rss_feed AS (
  SELECT 'rss' AS source_type, 'rss_' || url AS source_id, {PAGE_TITLE} AS title,
         html AS description, NULL::DOUBLE AS value, {LANGUAGE} AS category,
         coalesce({LANGUAGE}, '') AS tags, NULL::TIMESTAMP AS source_timestamp,
         url AS origin, url AS link
  FROM pages),
text_feed AS (
  SELECT 'text' AS source_type, 'text_' || doc_id AS source_id, 'Document ' || doc_id AS title,
         text AS description, n_chars::DOUBLE AS value, lang AS category,
         lang || ',' || source AS tags, NULL::TIMESTAMP AS source_timestamp,
         source AS origin, NULL::VARCHAR AS link
  FROM documents)"""

# Runs per event type and day, as derived in the feeds module.
RUNS = f"""
days AS (
  SELECT event_type AS source_type, date_trunc('day', ts)::TIMESTAMP AS day, min(ts) AS first,
         max(ts) AS last, count(*) AS handled, count(DISTINCT user_id) AS users,
         count(*) FILTER (value < 10) AS bad, max(value) AS peak
  FROM events GROUP BY ALL),
ends AS (
  SELECT *, epoch_us(last) - epoch_us(day) < 85800000000 AS ended,
         source_type = 'error' OR peak > 400 AS broke,
         least(users, handled - bad) AS fresh, strftime(day, '%Y-%m-%d') AS label
  FROM days),
runs AS (
  SELECT 'run_' || strftime(first, '%Y%m%d_%H%M%S') || '_'
           || substr(md5(source_type || '|' || label), 1, 8) AS run_id,
         source_type, first AS started_at, CASE WHEN ended THEN last END AS completed_at,
         CASE WHEN ended THEN (epoch_us(last) - epoch_us(first)) / 1e6 END AS duration_seconds,
         CASE WHEN ended THEN handled - bad ELSE 0 END::BIGINT AS records_processed,
         CASE WHEN ended THEN fresh ELSE 0 END::BIGINT AS records_inserted,
         CASE WHEN ended THEN handled - bad - fresh ELSE 0 END::BIGINT AS records_updated,
         CASE WHEN ended THEN bad ELSE 0 END::BIGINT AS records_failed,
         CASE WHEN NOT ended THEN 'running' WHEN broke THEN 'failure' ELSE 'success' END AS status,
         CASE WHEN ended AND broke THEN 'stopped on ' || label END AS error_message,
         label
  FROM ends)"""

CHECKPOINTS = f"""{RUNS},
checkpoints AS (
  SELECT source_type,
         arg_max(run_id, completed_at) FILTER (status = 'success') AS last_processed_id,
         max(completed_at) FILTER (status = 'success') AS last_processed_timestamp,
         max(completed_at) FILTER (status = 'success') AS last_success_at,
         max(completed_at) FILTER (status = 'failure') AS last_failure_at,
         sum(records_processed)::BIGINT AS records_processed,
         arg_max(status, greatest(started_at, coalesce(completed_at, started_at))) AS status,
         CASE WHEN arg_max(status, completed_at) FILTER (status <> 'running') = 'failure'
              THEN arg_max(error_message, completed_at) FILTER (status <> 'running') END AS error_message,
         arg_max(label, greatest(started_at, coalesce(completed_at, started_at))) AS label
  FROM runs GROUP BY source_type)"""

# The drifting event records and what is wrong with each.
DRIFT = r"""
raw AS (
  SELECT event_id, ts, event_type,
         '{' || CASE WHEN event_type = 'view' THEN '"usr_id":' ELSE '"user_id":' END || user_id
         || ',"event_type":"' || event_type || '"'
         || CASE WHEN event_type = 'error' THEN ',"value":"unknown"'
                 WHEN event_type = 'click' THEN '' ELSE ',"value":' || value END
         || CASE WHEN event_type = 'signup' THEN ',"props":' || props ELSE '' END || '}' AS raw_data
  FROM events),
keyed AS (SELECT *, json_keys(raw_data) AS fields FROM raw),
drift AS (
  SELECT event_id, ts, event_type,
         list_filter(['event_type', 'user_id', 'value'], lambda f: NOT list_contains(fields, f)) AS missing,
         list_sort(list_filter(fields, lambda f: NOT list_contains(['event_type', 'user_id', 'value'], f))) AS extra,
         CASE WHEN json_type(raw_data, '$.value') IN ('VARCHAR', 'BOOLEAN', 'ARRAY', 'OBJECT') THEN 1 ELSE 0 END
         + CASE WHEN json_type(raw_data, '$.user_id') IN ('VARCHAR', 'BOOLEAN', 'ARRAY', 'OBJECT') THEN 1 ELSE 0 END
           AS mistyped,
         json_extract_string(raw_data, '$.value') AS shown
  FROM keyed),
scored AS (
  SELECT *, round(0.4 * least(1.0, len(missing) / 3.0::DOUBLE * 2) + 0.3 * least(1.0, len(extra) / 3.0::DOUBLE * 2)
         + 0.3 * least(1.0, mistyped / 3.0::DOUBLE * 2), 3) AS confidence,
         len(missing) + len(extra) + mistyped > 0 AS has_drift
  FROM drift)"""
