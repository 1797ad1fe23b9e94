"""Schema drift: fields that went missing, appeared or changed type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweave.functions import scalars as S
from feedweave.functions.similarity import name_similarity
from feedweave.operators.normalize import json_kind
from feedweave.schemas import DRIFT_LOG, MISMATCH, SUGGESTION
from feedweave.session import stage

# Weights of the three kinds of drift and the thresholds used on the result.
MISSING_WEIGHT = 0.4
EXTRA_WEIGHT = 0.3
TYPE_WEIGHT = 0.3
SIMILARITY_THRESHOLD = 0.6
WARNING_CONFIDENCE = 0.5
SHOWN_VALUE = 50

# What ``detect`` adds.
COLUMNS = ["has_drift", "confidence_score", "missing_fields", "extra_fields", "type_mismatches"]

# JSON type names as the type names used in expected schemas.
KIND_NAMES = {
    "BIGINT": "int", "DECIMAL": "float", "DOUBLE": "float", "FLOAT": "float",
    "STRING": "str", "BOOLEAN": "bool", "ARRAY": "list", "OBJECT": "dict",
}


def _names(values) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)]).cast("array<string>")


def missing_fields(fields: Column, expected: Mapping[str, str]) -> Column:
    return F.array_except(_names(expected), fields)


def extra_fields(fields: Column, expected: Mapping[str, str]) -> Column:
    return F.array_sort(F.array_except(fields, _names(expected)))


def common_fields(fields: Column, expected: Mapping[str, str]) -> Column:
    return F.array_intersect(_names(expected), fields)


def _mismatches(checks: list[tuple[str, str, Column, Column]]) -> Column:
    """``checks`` holds (field, expected type, actual type, value); a null type is skipped."""
    empty = F.array().cast(T.ArrayType(MISMATCH))
    marks = []
    for field, expected, actual, value in checks:
        same = F.lit(expected == "str") | (actual == expected)
        if expected in ("int", "float"):
            same = same | actual.isin("int", "float")
        marks.append(
            F.when(
                actual.isNotNull() & ~same,
                F.struct(
                    F.lit(field).alias("field"),
                    F.lit(expected).alias("expected_type"),
                    actual.alias("actual_type"),
                    S.truncate(value, SHOWN_VALUE).alias("value"),
                ),
            )
        )
    return F.array_compact(F.array(*marks)).cast(T.ArrayType(MISMATCH)) if marks else empty


def _checked(expected: Mapping[str, str]) -> list[str]:
    """A field expected to be text accepts any type, so it need not be looked at."""
    return [f for f in sorted(expected) if expected[f] != "str"]


def json_mismatches(record: Column, expected: Mapping[str, str]) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    checks = []
    for field in _checked(expected):
        path = f"$['{field}']"
        kind = json_kind(record, path)
        text = F.try_variant_get(record, path, "string")
        value = F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
        checks.append((field, expected[field], F.try_element_at(kinds, kind), value))
    return _mismatches(checks)


def text_mismatches(columns: Mapping[str, Column], expected: Mapping[str, str]) -> Column:
    """For feeds that carry text only, a value has the type it can be read as."""
    checks = []
    for field in _checked(expected):
        if field in columns:
            text = columns[field]
            actual = F.when(text.isNotNull(), F.when(S.is_number(text), "float").otherwise("str"))
            checks.append((field, expected[field], actual, text))
    return _mismatches(checks)


def confidence(total: int, missing: Column, extra: Column, mismatched: Column) -> Column:
    if total == 0:
        return F.lit(0.0)

    def score(count: Column) -> Column:
        return F.least(F.lit(1.0), count / F.lit(float(total)) * 2)

    return F.round(
        score(missing) * MISSING_WEIGHT
        + score(extra) * EXTRA_WEIGHT
        + score(mismatched) * TYPE_WEIGHT,
        3,
    )


def severity(score: Column) -> Column:
    return F.when(score > WARNING_CONFIDENCE, "WARNING").otherwise("INFO")


def detect(
    df: DataFrame,
    expected: Mapping[str, str] | None,
    fields: Column | None = None,
    mismatches: Column | None = None,
) -> DataFrame:
    """Add the drift columns to each record; without an expected schema nothing drifts."""
    no_names = F.array().cast("array<string>")
    no_types = F.array().cast(T.ArrayType(MISMATCH))
    if not expected:
        return df.withColumns(
            {
                "has_drift": F.lit(False),
                "confidence_score": F.lit(0.0),
                "missing_fields": no_names,
                "extra_fields": no_names,
                "type_mismatches": no_types,
            }
        )
    fields = F.col("fields") if fields is None else fields
    found = df.withColumns(
        {
            "missing_fields": missing_fields(fields, expected),
            "extra_fields": extra_fields(fields, expected),
            "type_mismatches": no_types if mismatches is None else mismatches,
        }
    )
    sizes = [F.size(c) for c in ("missing_fields", "extra_fields", "type_mismatches")]
    return found.withColumns(
        {
            "has_drift": (sizes[0] + sizes[1] + sizes[2]) > 0,
            "confidence_score": confidence(len(expected), *sizes),
        }
    )


def field_shapes(drift: DataFrame) -> DataFrame:
    """Distinct (missing, extra) field lists; few, however many records there are."""
    both = (F.size("missing_fields") > 0) & (F.size("extra_fields") > 0)
    return drift.filter(both).select("missing_fields", "extra_fields").distinct()


def suggestions(shapes: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Rename suggestions per distinct field shape: the closest extra name, ties by name.

    Each pair of names is scored once, in however many shapes it occurs.
    """
    exploded = shapes.withColumn("missing_field", F.explode("missing_fields")).withColumn(
        "suggested_field", F.explode("extra_fields")
    )
    scored = (
        exploded.select("missing_field", "suggested_field")
        .distinct()
        .withColumn("ratio", name_similarity("missing_field", "suggested_field"))
        .filter(F.col("ratio") > threshold)
        .withColumn("similarity", F.round("ratio", 3))
    )
    best = (
        exploded.join(scored, ["missing_field", "suggested_field"])
        .groupBy("missing_fields", "extra_fields", "missing_field")
        .agg(
            F.min_by(
                F.struct("missing_field", "suggested_field", "similarity"),
                F.struct(-F.col("ratio"), "suggested_field"),
            ).alias("hit")
        )
    )
    return best.groupBy("missing_fields", "extra_fields").agg(
        F.array_sort(F.collect_list("hit")).cast(T.ArrayType(SUGGESTION)).alias("fuzzy_suggestions")
    )


def with_suggestions(
    drift: DataFrame, threshold: float = SIMILARITY_THRESHOLD, folder: str | None = None
) -> DataFrame:
    """Attach rename suggestions, computed once per distinct field shape."""
    none = F.array().cast(T.ArrayType(SUGGESTION))
    shapes = stage(field_shapes(drift), "shapes", folder)
    if shapes.isEmpty():
        return drift.withColumn("fuzzy_suggestions", none)
    hints = stage(suggestions(shapes, threshold), "suggestions", folder)
    return drift.join(hints, ["missing_fields", "extra_fields"], "left").withColumn(
        "fuzzy_suggestions", F.coalesce("fuzzy_suggestions", none)
    )


def log_rows(drift: DataFrame, source_name: Column, record_id: Column, at: Column) -> DataFrame:
    """Rows for the drift log: drifted records only."""
    made = {"source_name": source_name, "record_id": record_id, "detected_at": at}
    if "fuzzy_suggestions" not in drift.columns:
        made["fuzzy_suggestions"] = F.array()
    return drift.filter("has_drift").select(
        *[
            made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in DRIFT_LOG.fields
        ]
    )
