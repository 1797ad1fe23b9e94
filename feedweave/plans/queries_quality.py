"""Conversions, validation, audits and schema drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave import schemas
from feedweave.functions import scalars as S
from feedweave.operators import drift as D
from feedweave.operators import normalize as N
from feedweave.operators import reads
from feedweave.operators import validate as V
from feedweave.operators.metrics import drift_by_source as events_by_source
from feedweave.plans import sql
from feedweave.plans import tables as t
from feedweave.plans.catalog import query
from feedweave.session import stage


@query("""SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN NULL ELSE value END AS loose FROM events""")
def safe_casts(spark, folder):
    kind = F.col("event_type")
    loose = F.when(kind == "view", F.concat(F.lit("~"), F.col("value").cast("string"))).when(
        kind == "click", F.concat(F.col("value").cast("string"), F.lit("d"))
    ).otherwise(F.concat(F.lit("  "), F.col("value").cast("string"), F.lit("\t")))
    return t.table(spark, folder, "events").select(
        "event_id", S.safe_float(F.get_json_object("props", "$.k")).alias("k"), S.safe_float(loose).alias("loose")
    )


@query(f"""SELECT event_id, CASE event_type
  WHEN 'view' THEN {sql.stamp("date_trunc('second', ts)")}
  WHEN 'click' THEN {sql.stamp("date_trunc('day', ts)")}
  WHEN 'signup' THEN {sql.stamp("date_trunc('second', ts) - INTERVAL 2 HOUR")}
  WHEN 'purchase' THEN {sql.stamp('ts')} END AS parsed FROM events""")
def safe_timestamps(spark, folder):
    ts, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format(ts, "'Mon, 'dd MMM yyyy HH:mm:ss' GMT'"))
        .when(kind == "click", F.date_format(ts, "MM/dd/yyyy"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise(F.concat(F.lit("about "), ts.cast("string")))
    )
    return t.table(spark, folder, "events").select("event_id", t.text_of(S.safe_timestamp(text)).alias("parsed"))


@query("""SELECT event_id, substr(md5(json_object('event_id', event_id::VARCHAR, 'event_type', event_type, 'props', props,
'user_id', user_id::VARCHAR)::VARCHAR), 1, 16) AS content FROM events""")
def content_hash(spark, folder):
    names = ["user_id", "props", "event_type", "event_id"]
    content = S.content_text({n: F.col(n) for n in names})
    return t.table(spark, folder, "events").select("event_id", F.substring(F.md5(content), 1, 16).alias("content"))


@query("""SELECT p_partkey AS id, p_name AS ticker_title, p_brand || ' ' || p_type AS ticker_description,
p_retailprice AS ticker_value, p_size::VARCHAR AS ticker_category, p_brand AS market_description,
p_retailprice AS market_value,
CASE WHEN p_size <= 10 THEN 'top-10' WHEN p_size <= 100 THEN 'top-100' ELSE 'other' END AS market_category,
'2024-01-15 10:30:00' AS market_time FROM part""")
def nested_payload(spark, folder):
    quote = F.struct(F.struct(F.col("p_retailprice").alias("price")).alias("USD"))
    doc = F.to_json(
        F.struct(
            F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"), F.col("p_type").alias("description"),
            F.col("p_size").alias("rank"), F.col("p_size").alias("market_cap_rank"),
            F.col("p_retailprice").alias("current_price"), quote.alias("quotes"),
            F.lit("2024-01-15T10:30:00.000Z").alias("last_updated"),
        )
    )
    record = F.try_parse_json(doc)
    ticker, market = N.ticker_quote(record), N.market_quote(record)
    return t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        *[v.alias(f"ticker_{k}") for k, v in ticker.items()],
        *[market[k].alias(f"market_{k}") for k in ("description", "value", "category")],
        F.date_format(market["source_timestamp"], "yyyy-MM-dd HH:mm:ss").alias("market_time"),
    )


@query(f"""WITH {sql.FEEDS} SELECT source_id, split_part(tags, ',', 1) AS first_tag FROM api2_feed
UNION ALL SELECT source_id, nullif(tags, '') FROM rss_feed""")
def first_tag(spark, folder):
    tags = N.unify([t.parts(spark, folder), t.pages(spark, folder)])
    return tags.select("source_id", F.get("tags", F.lit(0)).alias("first_tag"))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'fallback' ELSE event_type END AS name FROM events""")
def field_fallback(spark, folder):
    """The first field present decides, even when it holds null."""
    kind = F.col("event_type")
    name = F.when(kind != "view", kind)
    options = [(kind != "click", name), (F.lit(False), F.lit("title"))]
    picked = S.first_present(options, F.lit("fallback"))
    return t.table(spark, folder, "events").select("event_id", picked.alias("name"))


def _account_rows(spark, folder):
    """Customers, suppliers and documents as CSV cells, some of them out of order."""
    c = t.table(spark, folder, "customer")
    s = t.table(spark, folder, "supplier")
    d = t.table(spark, folder, "documents")
    customers = c.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).otherwise("").alias("title"),
        F.col("c_acctbal").cast("string").alias("value"),
    )
    suppliers = s.select(
        F.when(F.col("s_nationkey") > 2, F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("id"),
        F.nullif("s_name", F.lit("Supplier#000000007")).alias("title"),
        F.col("s_acctbal").cast("string").alias("value"),
    )
    texts = d.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text").alias("title"), F.lit("many").alias("value"),
    )
    return customers.unionByName(suppliers).unionByName(texts)


_ACCOUNTS = """rows AS (
  SELECT 'c' || c_custkey AS id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name ELSE '' END AS title, c_acctbal AS value FROM customer
  UNION ALL SELECT CASE WHEN s_nationkey > 2 THEN 's' || s_suppkey END, nullif(s_name, 'Supplier#000000007'), s_acctbal FROM supplier
  UNION ALL SELECT 'd' || doc_id, text, NULL FROM documents),
judged AS (SELECT *, 'csv_' || coalesce(id, 'None') AS source_id, concat_ws(',',
    CASE WHEN id IS NULL THEN 'id_missing' END, CASE WHEN title IS NULL THEN 'title_missing' END,
    CASE WHEN title = '' THEN 'title_empty' END, CASE WHEN length(title) > 500 THEN 'title_too_long' END,
    CASE WHEN value < 0 THEN 'value_negative' END) AS reasons FROM rows)"""


@query(f"""WITH {_ACCOUNTS} SELECT source_id, value, md5(title) AS title_md5 FROM judged WHERE reasons = ''""")
def validate_csv(spark, folder):
    parsed = N.parse_csv(_account_rows(spark, folder))
    return V.valid(parsed).select("source_id", "value", F.md5("title").alias("title_md5"))


@query(f"""WITH {_ACCOUNTS} SELECT source_id, reasons FROM judged WHERE reasons <> ''""")
def quarantined_csv(spark, folder):
    bad = V.quarantine(N.parse_csv(_account_rows(spark, folder)))
    return bad.select("source_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {_ACCOUNTS} SELECT 'csv' AS source_type, reason, count(*) AS records
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM judged WHERE reasons <> '') GROUP BY reason""")
def quarantine_reasons(spark, folder):
    return V.reason_counts(N.parse_csv(_account_rows(spark, folder)))


@query("""SELECT CASE WHEN event_type = 'view' THEN 'id_not_string' WHEN event_type = 'signup' THEN 'name_not_string'
WHEN event_type = 'error' THEN 'tags_not_string_list' WHEN event_type = 'click' THEN 'name_empty,type_not_string' ELSE '' END AS reasons,
count(*) AS records FROM events GROUP BY 1""")
def validate_api(spark, folder):
    kind = F.col("event_type")
    id = F.col("event_id").cast("string")
    text = F.concat(
        F.lit('{"id":'), F.when(kind == "view", id).otherwise(F.concat(F.lit('"'), id, F.lit('"'))),
        F.lit(',"name":'), F.when(kind == "signup", "null").when(kind == "click", '""').otherwise('"n"'),
        F.lit(',"type":'), F.when(kind == "click", "[1]").otherwise("null"),
        F.lit(',"tags":'), F.when(kind == "error", '["a",1]').when(kind == "view", "null").otherwise('["a","b"]'),
        F.lit("}"),
    )
    parsed = t.api_records(t.table(spark, folder, "events").select(text.alias("raw_data")), "api1")
    return parsed.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("records"))


@query(f"""SELECT page_id, concat_ws(',', CASE WHEN nullif({sql.PAGE_TITLE}, '') IS NULL THEN 'title_missing' END,
CASE WHEN {sql.LANGUAGE} IS DISTINCT FROM 'en' THEN 'link_missing' END) AS reasons FROM pages""")
def validate_rss(spark, folder):
    pages = t.table(spark, folder, "pages")
    title = F.nullif(F.regexp_extract("html", t.HTML_TITLE, 1), F.lit(""))
    english = t.url_slug(F.col("url"), t.PATH_LANGUAGE) == "en"
    link = F.when(english, F.col("url"))
    rules = V.rss_rules(title, link)
    return pages.select("page_id", F.array_join(V.failed_rules(rules), ",").alias("reasons"))


def _audited(spark, folder):
    """Line items keyed by order line, which repeats, and documents titled by their text."""
    lines = t.table(spark, folder, "lineitem").select(
        F.lit("csv").alias("source_type"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("source_id"),
        F.lit("n").alias("canonical_id"), F.col("l_returnflag").alias("title"), F.col("l_linestatus").alias("category"),
    )
    texts = t.table(spark, folder, "documents").select(
        F.lit("text").alias("source_type"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("source_id"),
        S.null_text().alias("canonical_id"), F.when(F.col("lang") != "es", F.col("text")).alias("title"),
        F.col("text").alias("category"),
    )
    return lines.unionByName(texts)


_AUDITED = """audited AS (
  SELECT 'csv' AS source_type, l_orderkey || '-' || l_linenumber AS source_id, 'n' AS canonical_id, l_returnflag AS title, l_linestatus AS category FROM lineitem
  UNION ALL SELECT 'text', 'd' || doc_id, NULL, CASE WHEN lang <> 'es' THEN text END, text FROM documents)"""


@query(f"""WITH {_AUDITED}, one AS (SELECT
  count(*) FILTER (source_type IS NULL) AS source_type_null, count(*) FILTER (source_id IS NULL) AS source_id_null,
  count(*) FILTER (title IS NULL) AS title_null, count(*) FILTER (length(source_type) > 50) AS source_type_too_long,
  count(*) FILTER (length(source_id) > 255) AS source_id_too_long, count(*) FILTER (length(canonical_id) > 255) AS canonical_id_too_long,
  count(*) FILTER (length(title) > 500) AS title_too_long, count(*) FILTER (length(category) > 100) AS category_too_long,
  count(*) FILTER (source_type NOT IN ('csv', 'api1', 'api2', 'rss')) AS source_type_unknown,
  count(*) - count(DISTINCT source_id) AS source_id_repeated FROM audited)
SELECT rule, violations FROM (UNPIVOT one ON COLUMNS(*) INTO NAME rule VALUE violations)""")
def constraint_audit(spark, folder):
    return V.audit(_audited(spark, folder))


@query(f"""WITH {_AUDITED}, one AS (SELECT max(length(source_id))::BIGINT AS source_id, max(length(title))::BIGINT AS title,
max(length(category))::BIGINT AS category FROM audited)
SELECT column_name, max_length, CASE column_name WHEN 'source_id' THEN 255 WHEN 'title' THEN 500 ELSE 100 END::BIGINT AS limit_length
FROM (UNPIVOT one ON COLUMNS(*) INTO NAME column_name VALUE max_length)""")
def longest_values(spark, folder):
    return V.longest(_audited(spark, folder), ["source_id", "title", "category"])


@query(f"""WITH {sql.DRIFT} SELECT event_id, array_to_string(missing, ',') AS missing, array_to_string(extra, ',') AS extra,
CASE WHEN event_type = 'view' THEN 'event_type,value' WHEN event_type = 'click' THEN 'event_type,user_id' ELSE 'event_type,user_id,value' END AS common
FROM scored""")
def drift_fields(spark, folder):
    found = t.drift_of_events(spark, folder)
    return found.select(
        "event_id", F.array_join("missing_fields", ",").alias("missing"), F.array_join("extra_fields", ",").alias("extra"),
        F.array_join(D.common_fields(F.col("fields"), t.EVENT_FIELDS), ",").alias("common"),
    )


@query(f"""WITH {sql.DRIFT} SELECT event_id, confidence, has_drift,
CASE WHEN confidence > 0.5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM scored""")
def drift_confidence(spark, folder):
    return t.drift_of_events(spark, folder).select(
        "event_id", F.col("confidence_score").alias("confidence"), "has_drift",
        D.severity(F.col("confidence_score")).alias("severity"),
    )


@query(f"""WITH {sql.DRIFT} SELECT event_id, 'value' AS field, 'float' AS expected_type, 'str' AS actual_type,
substr(shown, 1, 50) AS value FROM scored WHERE mistyped > 0""")
def drift_types(spark, folder):
    found = t.drift_of_events(spark, folder)
    return found.select("event_id", F.inline("type_mismatches"))


@query(f"""WITH {sql.DRIFT} SELECT event_type AS source_name, count(*) AS events FROM scored WHERE has_drift GROUP BY 1""")
def drift_by_source(spark, folder):
    return events_by_source(t.drift_log(spark, folder))


@query(f"""WITH {sql.DRIFT} SELECT event_type AS source_name, event_id::VARCHAR AS record_id, confidence AS confidence_score,
array_to_string(missing, ',') AS missing, {sql.stamp('ts')} AS detected_at FROM scored WHERE has_drift
ORDER BY ts DESC, source_name, record_id LIMIT 10""")
def drift_latest(spark, folder):
    return reads.latest_drift(t.drift_log(spark, folder), 10).select(
        "source_name", "record_id", "confidence_score", F.array_join("missing_fields", ",").alias("missing"),
        t.text_of("detected_at").alias("detected_at"),
    )


@query("""SELECT event_id, FALSE AS has_drift, 0.0::DOUBLE AS confidence_score, 0 AS missing FROM events""")
def drift_without_schema(spark, folder):
    return D.detect(t.drifting_json(spark, folder), None).select(
        "event_id", "has_drift", "confidence_score", F.size("missing_fields").alias("missing")
    )


def _part_drift(spark, folder):
    part = t.table(spark, folder, "part")
    raw = part.select("p_partkey", F.to_json(F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("names"), F.col("p_brand").alias("symbols"),
        F.col("p_size").alias("ranks"), F.col("p_retailprice").alias("price_eur"),
    )).alias("raw_data"))
    keyed = raw.withColumn("fields", F.json_object_keys("raw_data"))
    return D.detect(keyed, schemas.EXPECTED_FIELDS["api"])


# Matching-block ratios above the threshold of the names that meet in the given tables.
_RATIOS = """ratios(missing_field, suggested_field, ratio) AS (VALUES
('user_id', 'usr_id', 0.9230769230769231), ('name', 'names', 0.8888888888888888), ('symbol', 'symbols', 0.9230769230769231), ('rank', 'ranks', 0.8888888888888888), ('price_usd', 'price_eur', 0.7777777777777778))"""
_HINTS = f"""{_RATIOS},
shapes AS (
  SELECT DISTINCT missing, extra FROM drift WHERE len(missing) > 0 AND len(extra) > 0
  UNION SELECT DISTINCT ['market_cap_usd', 'name', 'percent_change_24h', 'price_usd', 'rank', 'symbol', 'volume_24h_usd'],
    ['names', 'price_eur', 'ranks', 'symbols'] FROM part),
hints AS (
  SELECT missing, extra, missing_field, suggested_field, round(ratio, 3) AS similarity
  FROM (SELECT *, unnest(missing) AS missing_field FROM (SELECT *, unnest(extra) AS suggested_field FROM shapes))
  JOIN ratios USING (missing_field, suggested_field)
  QUALIFY row_number() OVER (PARTITION BY missing, extra, missing_field ORDER BY ratio DESC, suggested_field) = 1)"""


@query(f"""WITH {sql.DRIFT}, {_HINTS} SELECT DISTINCT missing_field, suggested_field, similarity::DOUBLE AS similarity FROM hints""")
def drift_suggestions(spark, folder):
    """Rename suggestions for events and parts."""
    shapes = D.field_shapes(t.drift_of_events(spark, folder)).unionByName(
        D.field_shapes(_part_drift(spark, folder))
    )
    found = D.suggestions(stage(shapes, "shapes"))
    return found.select(F.inline("fuzzy_suggestions")).distinct()


@query(f"""WITH {sql.DRIFT}, {_HINTS} SELECT event_id, event_type, coalesce((
  SELECT string_agg(missing_field || '>' || suggested_field || ' ' || similarity, ',' ORDER BY missing_field) FROM hints h
  WHERE h.missing = s.missing AND h.extra = s.extra), '') AS suggested FROM scored s WHERE has_drift""")
def drift_with_suggestions(spark, folder):
    """Every drifted record with its suggestions."""
    return D.with_suggestions(t.drift_of_events(spark, folder)).filter("has_drift").select(
        "event_id", "event_type",
        F.array_join(F.transform("fuzzy_suggestions", lambda s: F.concat(
            s["missing_field"], F.lit(">"), s["suggested_field"], F.lit(" "), s["similarity"].cast("string"))), ",").alias("suggested"),
    )
