"""Table schemas, field limits and the expected fields of each feed."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()
_META = T.MapType(_S, _S)


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


RAW_RECORDS = _table(
    source_type=_S, source_id=_S, source_name=_S, raw_data=_S, ingested_at=_TS
)

RECORDS = _table(
    source_type=_S, source_id=_S, canonical_id=_S, title=_S, description=_S, value=_D,
    category=_S, tags=T.ArrayType(_S), source_timestamp=_TS, created_at=_TS,
    updated_at=_TS, extra_metadata=_META,
)

CHECKPOINTS = _table(
    source_type=_S, last_processed_id=_S, last_processed_timestamp=_TS, last_success_at=_TS,
    last_failure_at=_TS, records_processed=_L, status=_S, error_message=_S,
    extra_metadata=_META,
)

# One row per thing that happened to a source: a run starting, progressing or ending.
CHECKPOINT_UPDATES = _table(
    source_type=_S, seq=_L, at=_TS, status=_S, records_processed=_L, last_processed_id=_S,
    last_processed_timestamp=_TS, error_message=_S, extra_metadata=_META,
)

RUNS = _table(
    run_id=_S, source_type=_S, started_at=_TS, completed_at=_TS, duration_seconds=_D,
    records_processed=_L, records_inserted=_L, records_updated=_L, records_failed=_L,
    status=_S, error_message=_S, extra_metadata=_META,
)

RUN_EVENTS = _table(
    run_id=_S, source_type=_S, at=_TS, status=_S, records_processed=_L, records_inserted=_L,
    records_updated=_L, records_failed=_L, error_message=_S, extra_metadata=_META,
)

# Events of a lake's runs in their order, with the progress a run has made.
LOG_EVENTS = T.StructType(
    [T.StructField("seq", _L), *RUN_EVENTS.fields, T.StructField("last_processed_id", _S), T.StructField("last_processed_timestamp", _TS)]
)

MISMATCH = _table(field=_S, expected_type=_S, actual_type=_S, value=_S)
SUGGESTION = _table(missing_field=_S, suggested_field=_S, similarity=_D)

DRIFT_LOG = _table(
    source_name=_S, record_id=_S, confidence_score=_D, missing_fields=T.ArrayType(_S),
    extra_fields=T.ArrayType(_S), type_mismatches=T.ArrayType(MISMATCH),
    fuzzy_suggestions=T.ArrayType(SUGGESTION), detected_at=_TS,
)

ENTITY_SKETCHES = _table(source_type=_S, sketch=T.BinaryType())

# Columns a reader of the unified table sees.
PUBLIC_COLUMNS = [
    "source_type", "source_id", "canonical_id", "title", "description", "value",
    "category", "tags", "source_timestamp", "extra_metadata",
]

# Vocabularies and column limits of the stored tables.
SOURCE_TYPES = ["csv", "api1", "api2", "rss"]
STATUSES = ["running", "success", "failure", "partial"]
LENGTH_LIMITS = {
    "source_type": 50,
    "source_id": 255,
    "canonical_id": 255,
    "title": 500,
    "category": 100,
}
RSS_SOURCE_ID_LIMIT = 500

# Fields and types each feed is expected to deliver.
EXPECTED_FIELDS = {
    "csv": {
        "id": "str",
        "title": "str",
        "description": "str",
        "value": "float",
        "category": "str",
        "timestamp": "str",
    },
    "api": {
        "id": "str",
        "name": "str",
        "symbol": "str",
        "rank": "int",
        "price_usd": "float",
        "market_cap_usd": "float",
        "volume_24h_usd": "float",
        "percent_change_24h": "float",
    },
    "rss": {
        "title": "str",
        "link": "str",
        "published": "str",
        "summary": "str",
        "id": "str",
    },
}
