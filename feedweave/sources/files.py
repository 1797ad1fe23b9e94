"""Readers for landed feed files: CSV, JSON API responses, RSS and Atom."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweave.functions.scalars import null_text
from feedweave.operators.normalize import UNREADABLE

CSV_COLUMNS = ["id", "title", "description", "value", "category", "timestamp"]

# Cell texts that mean "no value" in a CSV feed.
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_TEXT = T.StringType()
_CATEGORY = T.StructType(
    [T.StructField("_VALUE", _TEXT), T.StructField("_term", _TEXT)]
)
_LINK = T.StructType(
    [T.StructField("_VALUE", _TEXT), T.StructField("_href", _TEXT), T.StructField("_rel", _TEXT)]
)
_GUID = T.StructType([T.StructField("_VALUE", _TEXT), T.StructField("_isPermaLink", _TEXT)])

RSS_ITEM = T.StructType(
    [
        T.StructField("title", _TEXT),
        T.StructField("link", _TEXT),
        T.StructField("description", _TEXT),
        T.StructField("guid", _GUID),
        T.StructField("pubDate", _TEXT),
        T.StructField("category", T.ArrayType(_CATEGORY)),
    ]
)
ATOM_ENTRY = T.StructType(
    [
        T.StructField("id", _TEXT),
        T.StructField("title", T.StructType([T.StructField("_VALUE", _TEXT), T.StructField("_type", _TEXT)])),
        T.StructField("summary", T.StructType([T.StructField("_VALUE", _TEXT), T.StructField("_type", _TEXT)])),
        T.StructField("link", T.ArrayType(_LINK)),
        T.StructField("published", _TEXT),
        T.StructField("updated", _TEXT),
        T.StructField("category", T.ArrayType(_CATEGORY)),
    ]
)


# Cells beyond the header that are looked for in a row.
SURPLUS_CELLS = 64


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``header, files``: the first line of every file, one row for each different one.

    Only first blocks are read. Nothing is inferred.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    firsts = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return firsts.groupBy("header").agg(F.collect_list("file").alias("files"))


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of the feed: those of every header, in the order they are first met."""
    names: list[str] = []
    for header, _ in _layouts(spark, path):
        names += [n for n in header if n not in names]
    return names


def _layouts(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of each different header; the names of files go through the driver, as in any read."""
    found = []
    for row in csv_headers(spark, path).orderBy("header").collect():
        if row["header"]:
            names = next(csv.reader([row["header"].removeprefix("\ufeff").rstrip("\r")]))
            found.append(([n or f"_c{i}" for i, n in enumerate(names)], row["files"]))
    return found


def _csv_rows(spark: SparkSession, names: list[str], paths: list[str], multiline: bool) -> DataFrame:
    """Rows of files with one header; a row with more cells keeps its text in ``UNREADABLE``."""
    schema = T.StructType([T.StructField(n, _TEXT) for n in [*names, UNREADABLE]])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("columnPruning", False)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(paths)
    )
    # A row may be shorter than the header; only cells beyond it cannot be placed.
    wide = T.StructType([T.StructField(f"c{i}", _TEXT) for i in range(len(names) + SURPLUS_CELLS)])
    names_of_cells = ", ".join(f"{f.name} string" for f in wide.fields)
    cells = F.from_csv(F.col(UNREADABLE), names_of_cells, {"quote": '"', "escape": '"'})
    surplus = F.array_compact(F.array(*[cells[f"c{i}"] for i in range(len(names), len(names) + SURPLUS_CELLS)]))
    extra = F.when(F.col(UNREADABLE).isNotNull() & (F.size(surplus) > 0), F.col(UNREADABLE))
    return raw.select(
        *[F.when(~F.col(f"`{n}`").isin(CSV_NULLS), F.col(f"`{n}`")).alias(n) for n in names], extra.alias(UNREADABLE)
    )


def read_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = False,
    unreadable: bool = False,
) -> DataFrame:
    """CSV with a header, every column as text, placed by each file's own header.

    ``columns`` are the ones wanted, by default all; one that a file lacks is null there. With ``unreadable``
    a further column holds the text of rows with more cells than their header, which are left out otherwise.
    ``multiline`` is off by default so that large files stay splittable; set it only for
    feeds whose quoted cells contain line breaks.
    """
    layouts = _layouts(spark, path)
    names = columns or list(dict.fromkeys(n for header, _ in layouts for n in header)) or CSV_COLUMNS
    parts = [_csv_rows(spark, header, paths, multiline) for header, paths in layouts]
    if not parts:
        parts = [spark.createDataFrame([], T.StructType([T.StructField(n, _TEXT) for n in [*names, UNREADABLE]]))]
    wanted = [
        p.select(*[(F.col(f"`{n}`") if n in p.columns else null_text()).alias(n) for n in names], UNREADABLE) for p in parts
    ]
    rows = reduce(DataFrame.unionByName, wanted)
    return rows if unreadable else rows.filter(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def as_records(df: DataFrame, column: str = "raw_data") -> DataFrame:
    """Parse JSON texts into a ``record`` variant; null where the text is not JSON.

    The one-element explode keeps later filters above the parse. Pushed below, they would
    parse each text again for every field they look at.
    """
    return df.withColumn("record", F.explode(F.array(F.try_parse_json(column))))


def unwrap_payload(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per record of each API response text.

    A response is a bare list, an object with the list under ``data`` or, failing that,
    ``results``, or a single record. A response that is not JSON, or holds anything but a list
    there, gives one row with a null record and the text kept, and ``UNREADABLE`` says why.
    """
    parsed = df.withColumn("_doc", F.try_parse_json(column))
    doc = F.col("_doc")

    def kind(path: str):
        return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))

    def rows(path: str):
        return F.coalesce(F.try_variant_get(doc, path, "array<variant>"), F.array().cast("array<variant>"))

    listed = F.when(kind("$.data").isNotNull(), kind("$.data")).otherwise(kind("$.results"))
    is_list = F.schema_of_variant(doc).startswith("ARRAY")
    reason = F.when(doc.isNull(), "not_json").when(~is_list & listed.isNotNull() & ~listed.startswith("ARRAY"), "not_a_list")
    none = F.lit(None).cast("variant")
    records = (
        F.when(reason.isNotNull(), F.array(none))
        .when(is_list, rows("$"))
        .when(kind("$.data").isNotNull(), rows("$.data"))
        .when(kind("$.results").isNotNull(), rows("$.results"))
        .otherwise(F.array(doc))
    )
    exploded = parsed.withColumn(UNREADABLE, reason).withColumn("record", F.explode(records))
    return exploded.select(
        *[c for c in df.columns if c != column],
        "record",
        F.coalesce(F.to_json("record"), F.when(F.col(UNREADABLE).isNotNull(), F.col(column))).alias("raw_data"),
        UNREADABLE,
    )


def read_json_payloads(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed API responses: one response per line, or per file with ``whole_files``."""
    return unwrap_payload(spark.read.text(path, wholetext=whole_files))


def rss_columns(df: DataFrame) -> DataFrame:
    """RSS ``item`` rows in the common entry shape."""
    return df.select(
        F.coalesce(F.col("guid._VALUE"), F.col("link")).alias("id"),
        "title",
        F.col("description").alias("summary"),
        "link",
        F.col("pubDate").alias("published"),
        F.transform(
            F.coalesce(F.col("category"), F.array().cast(T.ArrayType(_CATEGORY))),
            lambda c: F.coalesce(c["_term"], c["_VALUE"]),
        ).alias("categories"),
        *[c for c in df.columns if c == UNREADABLE],
    )


def atom_columns(df: DataFrame) -> DataFrame:
    """Atom ``entry`` rows in the common entry shape."""
    links = F.col("link")
    page = F.filter(links, lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    href = F.coalesce(F.get(page, F.lit(0))["_href"], F.get(links, F.lit(0))["_href"])
    return df.select(
        F.coalesce(F.col("id"), href).alias("id"),
        F.col("title._VALUE").alias("title"),
        F.col("summary._VALUE").alias("summary"),
        href.alias("link"),
        F.coalesce("published", "updated").alias("published"),
        F.transform(
            F.coalesce(F.col("category"), F.array().cast(T.ArrayType(_CATEGORY))),
            lambda c: F.coalesce(c["_term"], c["_VALUE"]),
        ).alias("categories"),
        *[c for c in df.columns if c == UNREADABLE],
    )


def _elements(spark: SparkSession, path: str, tag: str, shape: T.StructType) -> DataFrame:
    """``e``, the parsed elements of a tag, and ``UNREADABLE``, the text of those that are not well-formed.

    Files are cut after each end tag, so large ones are split. An element that is never closed
    ends where the next one begins, which is read as usual.
    """
    cut = spark.read.option("lineSep", f"</{tag}>").text(path)
    pieces = F.split("value", f"(?=<{tag}[\\s/>])", -1)
    rows = cut.select(F.posexplode(pieces).alias("place", "piece"), F.size(pieces).alias("n"))
    rows = rows.filter(F.col("piece").rlike(f"^<{tag}[\\s/>]"))
    closed = F.col("place") == F.col("n") - 1
    text = F.when(closed, F.concat("piece", F.lit(f"</{tag}>"))).otherwise(F.col("piece"))
    marked = T.StructType([*shape.fields, T.StructField(UNREADABLE, _TEXT)])
    parsed = rows.select(text.alias("text"), F.from_xml(
        text, marked.json(), {"rowTag": tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}).alias("e"))
    broken = F.col("e").isNull() | F.col(f"e.{UNREADABLE}").isNotNull()
    return parsed.select(
        *[F.col(f"e.{f.name}").alias(f.name) for f in shape.fields], F.when(broken, F.col("text")).alias(UNREADABLE))


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    return rss_columns(_elements(spark, path, "item", RSS_ITEM))


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    return atom_columns(_elements(spark, path, "entry", ATOM_ENTRY))


def missing_as_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(
        *df.columns, *[null_text().alias(c) for c in columns if c not in df.columns]
    )
