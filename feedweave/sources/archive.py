"""Re-reading the raw archive, to normalise old records with new logic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.operators.normalize import ALIAS_FIELDS, STORED, ApiMapping, parse_api, parse_csv, parse_rss
from feedweave.sources.files import CSV_COLUMNS, as_records


def archived_csv(raw: DataFrame) -> DataFrame:
    """Stored CSV rows with the fields each of them had; ids and raw texts stay as stored."""
    names = [*CSV_COLUMNS, "guid", "link", *ALIAS_FIELDS]
    # The one-element explode keeps what looks at the cells above the reading of them: a text is read once.
    read = F.explode(F.array(F.from_json("raw_data", "map<string,string>")))
    cells = F.col("_cells")
    rows = raw.filter(F.col("source_type") == "csv").select("source_id", "raw_data", read.alias("_cells")).select(
        *[F.try_element_at(cells, F.lit(n)).alias(n) for n in names],
        F.col("source_id").alias(f"{STORED}id"), F.col("raw_data").alias(f"{STORED}raw"),
        F.map_keys(cells).alias(f"{STORED}fields"))
    return parse_csv(rows, stored={
        "source_id": F.col(f"{STORED}id"), "raw_data": F.col(f"{STORED}raw"), "fields": F.col(f"{STORED}fields")})


def archived_api(raw: DataFrame, feed: str, mapping: ApiMapping = ApiMapping()) -> DataFrame:
    rows = raw.filter((F.col("source_type") != "csv") & (F.col("source_name") == feed))
    return parse_api(as_records(rows.select("raw_data")), feed, mapping)


def archived_rss(raw: DataFrame) -> DataFrame:
    shape = "id string, title string, summary string, link string, published string, categories array<string>"
    rows = raw.filter(F.col("source_type") == "rss")
    return parse_rss(rows.select(F.from_json("raw_data", shape).alias("r")).select("r.*"))
