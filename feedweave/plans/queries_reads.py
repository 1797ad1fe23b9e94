"""Filtered, searched and paged reads of the unified table; merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.operators import merge as M
from feedweave.operators import reads
from feedweave.operators.normalize import to_records, unify
from feedweave.operators.resolve import AliasBook, resolve, slug_of_title
from feedweave.plans import sql
from feedweave.plans import tables as t
from feedweave.plans.catalog import query

_EVENTS = f"""{sql.FEEDS},
records AS (SELECT *, source_timestamp AS created_at, category AS canonical_id FROM api1_feed)"""
_ORDERS = f"""{sql.FEEDS},
records AS (SELECT *, source_timestamp AS created_at, lower(category) AS canonical_id FROM csv_feed)"""


def _shown(df, *more):
    return df.select("source_id", "title", "value", "category",
                     t.text_of("source_timestamp").alias("source_timestamp"), *more)


_SHOWN = f"source_id, title, value, category, {sql.stamp('source_timestamp')} AS source_timestamp"


@query(f"""WITH {_EVENTS} SELECT {_SHOWN} FROM records WHERE source_type = 'api1' AND category = 'purchase'
ORDER BY created_at DESC, source_id LIMIT 50 OFFSET 100""")
def data_page(spark, folder):
    records = reads.matching(t.event_records(spark, folder), source_type="api1", category="purchase", search="")
    return _shown(reads.page_of(records, page=3, page_size=50))


@query(f"""WITH {_ORDERS} SELECT {_SHOWN} FROM records
ORDER BY created_at DESC, source_id LIMIT 7 OFFSET 1400""")
def data_page_deep(spark, folder):
    """A page located by counting ranges, as done when it lies too deep to sort from the top."""
    return _shown(reads.deep_page(t.order_records(spark, folder), offset=1400, page_size=7))


@query(f"""WITH {_EVENTS} SELECT 2::INT AS page, 30::INT AS page_size, count(*) AS total_records,
((count(*) + 29) // 30)::BIGINT AS total_pages, '{{"category": "view", "canonical_id": "view"}}' AS filters_applied
FROM records WHERE category = 'view' AND canonical_id = 'view'""")
def data_page_meta(spark, folder):
    filters = {"category": "view", "canonical_id": "view", "search": ""}
    records = reads.matching(t.event_records(spark, folder), **filters)
    return reads.page_info(records, page=2, page_size=30, filters=filters)


@query(f"""WITH {sql.FEEDS},
feeds AS (SELECT source_id, title, description FROM text_feed UNION ALL SELECT source_id, title, description FROM rss_feed
          UNION ALL SELECT source_id, title, description FROM api2_feed)
SELECT source_id, title, md5(description) AS description_md5 FROM feeds
WHERE title ILIKE '%AN_I%' OR description ILIKE '%AN_I%'""")
def data_search(spark, folder):
    feeds = unify([f(spark, folder) for f in (t.documents, t.pages, t.parts)])
    return reads.matching(feeds, search="AN_I").select(
        "source_id", "title", F.md5("description").alias("description_md5")
    )


@query(f"""WITH {_ORDERS} SELECT {_SHOWN}, canonical_id FROM records WHERE canonical_id = 'p'
ORDER BY source_type, created_at DESC, source_id""")
def entity_sources(spark, folder):
    return _shown(reads.entity_records(t.order_records(spark, folder), "p"), "canonical_id")


@query(f"""WITH {_EVENTS} SELECT {_SHOWN} FROM records WHERE canonical_id = 'signup' ORDER BY created_at, source_id""")
def entity_history(spark, folder):
    return _shown(reads.entity_history(t.event_records(spark, folder), "signup"))


@query(f"""WITH {_ORDERS} SELECT {_SHOWN} FROM records WHERE canonical_id = 'f'
ORDER BY source_timestamp DESC, source_id""")
def entity_by_time(spark, folder):
    return _shown(reads.entity_by_freshness(t.order_records(spark, folder), "f"))


@query(f"""WITH {_EVENTS} SELECT {_SHOWN} FROM records
WHERE source_type = 'api1' AND created_at >= TIMESTAMP '2024-01-25' ORDER BY created_at DESC, source_id""")
def recent_by_source(spark, folder):
    return _shown(reads.recent_records(t.event_records(spark, folder), "api1", "2024-01-25 00:00:00"))


_KEY = "l_orderkey || '-' || l_linenumber"
_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus"]


def _line_key():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


@query(f"""SELECT {_KEY} AS source_id, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _ORDER)}) = 1""")
def last_wins(spark, folder):
    lines = t.table(spark, folder, "lineitem")
    latest = M.last_wins(lines, ["l_orderkey", "l_linenumber"], [F.col(c) for c in _ORDER])
    return latest.select(_line_key().alias("source_id"), "l_partkey", "l_suppkey", "l_quantity",
                         "l_extendedprice", "l_returnflag")


def _old_and_new(spark, folder):
    """Orders up to 1998 as stored rows; orders since 1997 as updates with other values."""
    records = t.order_records(spark, folder)
    old = records.filter(F.col("created_at") < F.lit("1999-01-01"))
    new = records.filter(F.col("created_at") >= F.lit("1998-01-01")).withColumns(
        {
            "title": F.concat(F.lit("late "), "title"),
            "value": F.when(F.col("category") != "P", F.round(F.col("value") * 2, 2)),
            "created_at": t.as_of(),
        }
    )
    return old, new


_MERGE = f"""{_ORDERS},
old AS (SELECT * FROM records WHERE created_at < TIMESTAMP '1999-01-01'),
new AS (SELECT * REPLACE ('late ' || title AS title, CASE WHEN category <> 'P' THEN round(value * 2, 2) END AS value,
        {sql.AT} AS created_at) FROM records WHERE created_at >= TIMESTAMP '1998-01-01'),
merged AS (SELECT coalesce(o.source_id, n.source_id) AS source_id, coalesce(o.source_type, n.source_type) AS source_type,
  CASE WHEN n.source_id IS NOT NULL THEN n.title ELSE o.title END AS title,
  CASE WHEN n.source_id IS NOT NULL THEN n.value ELSE o.value END AS value,
  {sql.stamp('coalesce(o.created_at, n.created_at)')} AS created_at,
  CASE WHEN o.source_id IS NOT NULL AND n.source_id IS NOT NULL THEN {sql.stamp(sql.AT)} END AS updated_at,
  CASE WHEN n.source_id IS NULL THEN 'keep' WHEN o.source_id IS NULL THEN 'insert' ELSE 'update' END AS merge_action
  FROM old o FULL JOIN new n ON o.source_id = n.source_id)"""


def _merged(df):
    return df.select("source_id", "title", "value", t.text_of("created_at").alias("created_at"),
                     t.text_of("updated_at").alias("updated_at"), "merge_action")


@query(f"""WITH {_MERGE} SELECT source_id, title, value, created_at, updated_at, merge_action FROM merged""")
def merge_records(spark, folder):
    old, new = _old_and_new(spark, folder)
    return _merged(M.merge_records(old, new, t.as_of()))


@query(f"""WITH {_MERGE} SELECT source_type, count(*) FILTER (merge_action = 'insert') AS inserted_keys,
count(*) FILTER (merge_action = 'update') AS updated_keys, count(*) FILTER (merge_action = 'keep') AS kept_keys
FROM merged GROUP BY 1""")
def merge_counts(spark, folder):
    old, new = _old_and_new(spark, folder)
    return M.merge_counts(M.merge_records(old, new, t.as_of()))


def _raw(df, at):
    return df.select(
        F.lit("csv").alias("source_type"), F.concat(F.lit("csv_"), "id").alias("source_id"),
        F.lit("csv").alias("source_name"), S.raw_json("id", "title", "category").alias("raw_data"),
        F.lit(at).cast("timestamp").alias("ingested_at"),
    )


@query("""WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
new AS (SELECT * REPLACE (lower(o_orderpriority) AS o_orderpriority) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
merged AS (SELECT coalesce(n.o_orderkey, o.o_orderkey)::VARCHAR AS id,
  coalesce(n.o_orderpriority, o.o_orderpriority) AS title, coalesce(n.o_orderstatus, o.o_orderstatus) AS category,
  CASE WHEN o.o_orderkey IS NULL THEN '2024-02-01' ELSE '2024-01-01' END AS ingested,
  CASE WHEN n.o_orderkey IS NULL THEN 'keep' WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS merge_action
  FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey)
SELECT 'csv_' || id AS source_id, json_object('id', id, 'title', title, 'category', category)::VARCHAR AS raw_data,
ingested, merge_action FROM merged""")
def merge_raw(spark, folder):
    rows = t.order_rows(spark, folder)
    old = _raw(rows.filter(F.col("timestamp") < "1999-01-01"), "2024-01-01")
    new = _raw(rows.filter(F.col("timestamp") >= "1998-01-01").withColumn("title", F.lower("title")), "2024-02-01")
    merged = M.merge_raw(old, new)
    return merged.select("source_id", "raw_data", F.date_format("ingested_at", "yyyy-MM-dd").alias("ingested"), "merge_action")


@query(f"""WITH batch AS (SELECT {_KEY} AS source_id, l_quantity > 45 AS bad, l_shipdate <= TIMESTAMP '1996-06-30' AS late FROM lineitem),
known AS (SELECT DISTINCT {_KEY} AS source_id FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
keys AS (SELECT b.source_id, count(*) FILTER (NOT bad AND NOT late) AS accepted, count(*) FILTER (bad) AS failed,
         count(*) FILTER (NOT bad AND late) AS skipped, k.source_id IS NULL AS fresh
         FROM batch b LEFT JOIN known k ON b.source_id = k.source_id GROUP BY b.source_id, k.source_id)
SELECT 'csv' AS source_type, sum(accepted)::BIGINT AS records_processed,
  count(*) FILTER (fresh AND accepted > 0) AS records_inserted,
  (sum(accepted) - count(*) FILTER (fresh AND accepted > 0))::BIGINT AS records_updated,
  sum(failed)::BIGINT AS records_failed, sum(skipped)::BIGINT AS records_skipped FROM keys""")
def ingest_counts(spark, folder):
    lines = t.table(spark, folder, "lineitem").withColumn("source_id", _line_key())
    batch = lines.select(
        F.lit("csv").alias("source_type"), "source_id",
        F.array_compact(F.array(F.when(F.col("l_quantity") > 45, "too_many"))).alias("reasons"),
        (F.col("l_shipdate") <= F.lit("1996-06-30").cast("timestamp_ntz")).alias("skipped"),
    )
    known = lines.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("source_id").distinct()
    return M.ingest_counts(batch, known)


_HALVES = f"""{_ORDERS},
stored AS (SELECT source_id FROM records WHERE created_at < TIMESTAMP '1999-01-01'),
incoming AS (SELECT source_id, title FROM records WHERE created_at >= TIMESTAMP '1998-01-01')"""


@query(f"""WITH {_HALVES} SELECT * FROM incoming WHERE source_id NOT IN (SELECT source_id FROM stored)""")
def new_keys_anti_join(spark, folder):
    old, new = _old_and_new(spark, folder)
    return M.new_keys(new, old).select("source_id", F.substring("title", 6, 500).alias("title"))


@query(f"""WITH {_HALVES} SELECT * FROM incoming WHERE source_id IN (SELECT source_id FROM stored)""")
def known_keys_semi_join(spark, folder):
    old, new = _old_and_new(spark, folder)
    return M.known_keys(new, old).select("source_id", F.substring("title", 6, 500).alias("title"))


@query(f"""WITH {sql.FEEDS}
SELECT source_type, source_id, title, NULL::VARCHAR AS canonical_id FROM csv_feed
UNION ALL SELECT source_type, source_id, title, {sql.slug('title')} FROM api2_feed""")
def add_column(spark, folder):
    """Rows stored before canonical_id existed, beside rows that have it."""
    old = to_records(t.orders(spark, folder), t.as_of()).drop("canonical_id")
    new = to_records(resolve(t.parts(spark, folder), AliasBook(), (slug_of_title,)), t.as_of())
    return M.add_columns(old, new).unionByName(new).select("source_type", "source_id", "title", "canonical_id")
