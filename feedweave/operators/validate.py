"""Record rules, the valid / quarantine split and the audit of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweave.schemas import LENGTH_LIMITS, RSS_SOURCE_ID_LIMIT, SOURCE_TYPES

TITLE_LIMIT = LENGTH_LIMITS["title"]


# Reasons of input that was not read as a record at all.
UNREADABLE_REASONS = ("surplus_cells", "not_a_list", "malformed_xml")


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a record breaks; empty for a valid record."""
    marks = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return F.array_compact(F.array(*marks))


def csv_rules(id: Column, title: Column, value: Column) -> dict[str, Column]:
    return {
        "id_missing": id.isNull(),
        "title_missing": title.isNull(),
        "title_empty": F.length(title) == 0,
        "title_too_long": F.length(title) > TITLE_LIMIT,
        "value_negative": value < 0,
    }


def api_rules(kinds: dict[str, Column], name: Column, tags_ok: Column) -> dict[str, Column]:
    """``kinds`` holds the JSON type of each field; null where the field is absent."""

    def not_text(field: str) -> Column:
        return ~F.coalesce(kinds[field], F.lit("VOID")).isin("STRING", "VOID")

    return {
        "id_not_string": ~F.coalesce(kinds["id"], F.lit("VOID")).eqNullSafe("STRING"),
        "name_not_string": ~F.coalesce(kinds["name"], F.lit("VOID")).eqNullSafe("STRING"),
        "name_empty": F.length(name) == 0,
        "description_not_string": not_text("description"),
        "type_not_string": not_text("type"),
        "tags_not_string_list": ~tags_ok,
    }


def rss_rules(title: Column, link: Column) -> dict[str, Column]:
    return {"title_missing": title.isNull(), "link_missing": link.isNull()}


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.size("reasons") == 0)


def quarantine(df: DataFrame) -> DataFrame:
    """Rejected records with the raw text and the rules they broke."""
    return df.filter(F.size("reasons") > 0).select(
        "source_type", "source_id", "raw_data", "reasons"
    )


def reason_counts(df: DataFrame) -> DataFrame:
    return (
        df.select("source_type", F.explode("reasons").alias("reason"))
        .groupBy("source_type", "reason")
        .agg(F.count("*").alias("records"))
    )


def _limit(column: str) -> Column:
    if column == "source_id":
        return F.when(F.col("source_type") == "rss", RSS_SOURCE_ID_LIMIT).otherwise(
            LENGTH_LIMITS["source_id"]
        )
    return F.lit(LENGTH_LIMITS[column])


def audit(
    records: DataFrame,
    required: tuple[str, ...] = ("source_type", "source_id", "title"),
    limited: tuple[str, ...] = ("source_type", "source_id", "canonical_id", "title", "category"),
    key: str = "source_id",
    source_types: list[str] | None = None,
) -> DataFrame:
    """One row per table constraint with the number of rows that break it.

    Nulls, lengths and vocabulary are counted in one pass; repeated keys come from a
    grouped count, which combines on the map side, so a hot key costs no more than others.
    """
    allowed = source_types or SOURCE_TYPES
    counts = {f"{c}_null": F.count_if(F.col(c).isNull()) for c in required}
    counts |= {f"{c}_too_long": F.count_if(F.length(c) > _limit(c)) for c in limited}
    counts["source_type_unknown"] = F.count_if(~F.col("source_type").isin(allowed))
    one_pass = records.agg(*[v.alias(k) for k, v in counts.items()])
    rows = one_pass.unpivot([], list(counts), "rule", "violations")
    repeats = (
        records.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        .select(F.lit(f"{key}_repeated").alias("rule"), "violations")
    )
    return rows.unionByName(repeats)


def longest(records: DataFrame, columns: list[str]) -> DataFrame:
    """Longest value of each column beside its limit."""
    widths = records.agg(*[F.max(F.length(c)).cast("long").alias(c) for c in columns])
    limits = F.create_map(*[F.lit(x) for c in columns for x in (c, LENGTH_LIMITS.get(c, 0))])
    return widths.unpivot([], columns, "column_name", "max_length").withColumn(
        "limit_length", F.try_element_at(limits, F.col("column_name")).cast("long")
    )
