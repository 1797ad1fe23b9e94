"""Feed records to the one unified shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweave.functions import scalars as S
from feedweave.operators import validate
from feedweave.schemas import PUBLIC_COLUMNS, RECORDS

# Fields of a record that may name an entity, in the order they are tried.
ALIAS_FIELDS = ["symbol", "ticker", "coin_symbol", "currency"]

# Column of a reader for what cannot be read as a record, and mark of columns kept from an archive.
UNREADABLE, STORED = "_unreadable", "_stored_"

# Shape of a parsed record: the unified fields, what identity is read from, the raw text,
# the fields it carried and the rules it broke.
PARSED_COLUMNS = [
    "source_type", "source_id", "title", "description", "value", "category", "tags",
    "source_timestamp", "extra_metadata", "identity", "raw_data", "fields", "reasons",
]


def identity(
    id: Column | None = None, link: Column | None = None, **fields: Column
) -> Column:
    parts = {"id": id, "link": link} | {f: fields.get(f) for f in ALIAS_FIELDS}
    return F.struct(
        *[(S.null_text() if v is None else v.cast("string")).alias(k) for k, v in parts.items()]
    )


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else S.null_text()


def unreadable(df: DataFrame) -> Column:
    """Text (or reason) of what a reader could not read as a record; null for records."""
    return F.col(UNREADABLE) if UNREADABLE in df.columns else S.null_text()


def parse_csv(
    df: DataFrame, source_type: str = "csv", stored: Mapping[str, Column] | None = None
) -> DataFrame:
    """CSV rows (all text) to parsed records.

    ``stored`` replaces what a row alone does not tell when it is read again: its id, raw text and fields.
    """
    present = [c for c in df.columns if c != UNREADABLE and not c.startswith(STORED)]
    stored = stored or {}
    content = S.content_text({c: F.col(f"`{c}`") for c in present})
    source_id = S.natural_source_id(
        source_type,
        **{f: F.col(f) for f in ("id", "guid", "link") if f in present},
        content=content,
        present={f: F.lit(True) for f in present},
    )
    source_id = stored.get("source_id", source_id)
    record_id = F.col("id") if "id" in present else source_id
    if stored:
        record_id = F.when(F.array_contains(stored["fields"], "id"), record_id).otherwise(source_id)
    title = _text(df, "title") if "title" in present else F.lit("")
    value = S.safe_float(_text(df, "value"))
    return df.select(
        F.lit(source_type).alias("source_type"),
        source_id.alias("source_id"),
        title.alias("title"),
        _text(df, "description").alias("description"),
        value.alias("value"),
        _text(df, "category").alias("category"),
        F.lit(None).cast("array<string>").alias("tags"),
        S.safe_timestamp(_text(df, "timestamp")).alias("source_timestamp"),
        F.create_map(F.lit("original_id"), record_id).alias("extra_metadata"),
        identity(
            id=F.col("id") if "id" in present else None,
            link=F.col("link") if "link" in present else None,
            **{f: F.col(f) for f in ALIAS_FIELDS if f in present},
        ).alias("identity"),
        stored.get("raw_data", F.coalesce(unreadable(df), S.raw_json(*[F.col(f"`{c}`") for c in present]))).alias("raw_data"),
        stored.get("fields", F.array(*[F.lit(c) for c in present])).alias("fields"),
        validate.failed_rules(
            {"surplus_cells": unreadable(df).isNotNull()} | validate.csv_rules(record_id, title, value)
        ).alias("reasons"),
    )


def json_kind(variant: Column, path: str) -> Column:
    """JSON type name of one field: STRING, BIGINT, VOID for null, SQL null when absent."""
    shape = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    return F.substring_index(F.substring_index(shape, "<", 1), "(", 1)


def _number(kind: Column, text: Column) -> Column:
    return F.when(kind == "BOOLEAN", (text == "true").cast("double")).when(
        ~kind.isin("OBJECT", "ARRAY"), S.safe_float(text)
    )


@dataclass(frozen=True)
class ApiMapping:
    """Where a provider puts the unified fields.

    Each list is tried in order and the first field *present* decides. A dotted name reaches
    into nested objects.
    """

    title: tuple[str, ...] = ("name", "title")
    description: tuple[str, ...] = ("description",)
    value: tuple[str, ...] = ("amount", "value")
    category: tuple[str, ...] = ("type", "category")
    timestamp: tuple[str, ...] = ("created_at",)
    #: Texts that make up the description together, instead of the first present.
    described_by: tuple[str, ...] = ()
    #: A rank whose bucket is the category of records that have one.
    rank: str | None = None


# Providers that quote prices under ``quotes.USD``, and with flat market columns.
TICKER_FEED = ApiMapping(
    value=("quotes.USD.price", "amount", "value"), category=("rank", "type", "category"),
    described_by=("symbol", "description"),
)
MARKET_FEED = ApiMapping(
    value=("current_price", "amount", "value"), timestamp=("last_updated", "created_at"),
    described_by=("symbol",), rank="market_cap_rank",
)


def parse_api(df: DataFrame, feed: str, mapping: ApiMapping = ApiMapping()) -> DataFrame:
    """JSON records (a ``record`` variant and its ``raw_data`` text) to parsed records.

    Ids carry the prefix ``api_<feed>``; the source type is ``api1`` for the feed of that
    name and ``api2`` for any other. Each field is taken out of the record once, as text and
    as type, and everything else is worked out from those.
    """
    prefix = f"api_{feed}"
    source_type = "api1" if feed == "api1" else "api2"
    wanted = ["id", "guid", "link", "tags", *ALIAS_FIELDS]
    ranks = (mapping.rank,) if mapping.rank else ()
    for names in (mapping.title, mapping.description, mapping.value, mapping.category, mapping.timestamp,
                  mapping.described_by, ranks):
        wanted += [n for n in names if n not in wanted]
    record = F.col("record")
    taken = {f"t_{n}": F.try_variant_get(record, f"$.{n}", "string") for n in wanted}
    taken |= {f"k_{n}": json_kind(record, f"$.{n}") for n in wanted}
    keyed = df.select("record", "raw_data", unreadable(df).alias(UNREADABLE), *[c.alias(n) for n, c in taken.items()])

    def text(name: str) -> Column:
        return F.col(f"`t_{name}`")

    def kind(name: str) -> Column:
        return F.col(f"`k_{name}`")

    def there(name: str) -> Column:
        return kind(name).isNotNull()

    def pick(names: tuple[str, ...], get, default: Column) -> Column:
        return S.first_present([(there(n), get(n)) for n in names], default)

    source_id = S.natural_source_id(
        prefix, id=text("id"), guid=text("guid"), link=text("link"),
        content=F.coalesce(S.sorted_json(F.col("raw_data")), F.col("raw_data")),
        present={n: there(n) for n in ("id", "guid", "link")},
    )
    record_id = F.when(there("id"), text("id")).otherwise(source_id)
    title = pick(mapping.title, text, F.lit(""))
    tags = F.try_variant_get(record, "$.tags", "array<string>")
    tag_items = F.try_variant_get(record, "$.tags", "array<variant>")
    tags_ok = (
        F.coalesce(kind("tags"), F.lit("VOID")).eqNullSafe("VOID")
        | (kind("tags").eqNullSafe("ARRAY")
           & F.forall(
               F.coalesce(tag_items, F.array().cast("array<variant>")),
               lambda t: F.schema_of_variant(t).eqNullSafe("STRING"),
           ))
    )
    kinds = {
        "id": F.coalesce(kind("id"), F.lit("STRING")),
        "name": pick(mapping.title, kind, F.lit("STRING")),
        "description": pick(mapping.description, kind, S.null_text()),
        "type": pick(tuple(n for n in mapping.category if n in ("type", "category")), kind, S.null_text()),
    }
    description = pick(mapping.description, text, S.null_text())
    if mapping.described_by:
        parts = F.concat_ws(" ", *[text(n) for n in mapping.described_by])
        description = F.when(F.length(parts) > 0, parts)
    category = pick(mapping.category, text, S.null_text())
    if mapping.rank:
        category = F.coalesce(rank_bucket(F.expr(f"try_cast(`t_{mapping.rank}` AS int)")), category)
    stamp = pick(mapping.timestamp, lambda n: F.when(kind(n) == "STRING", text(n)), S.null_text())
    rules = {
        "not_a_list": F.col(UNREADABLE).eqNullSafe("not_a_list"),
        "not_an_object": ~json_kind(record, "$").eqNullSafe("OBJECT"),
    } | validate.api_rules(kinds, title, tags_ok)
    return keyed.select(
        F.lit(source_type).alias("source_type"),
        source_id.alias("source_id"),
        title.alias("title"),
        description.alias("description"),
        pick(mapping.value, lambda n: _number(kind(n), text(n)), F.lit(None).cast("double")).alias("value"),
        category.alias("category"),
        F.when(there("tags"), tags).otherwise(F.array().cast("array<string>")).alias("tags"),
        S.safe_timestamp(stamp).alias("source_timestamp"),
        F.create_map(
            F.lit("original_id"), record_id, F.lit("source_name"), F.lit(feed)
        ).alias("extra_metadata"),
        identity(
            id=text("id"), link=text("link"), **{f: text(f) for f in ALIAS_FIELDS}
        ).alias("identity"),
        "raw_data",
        F.coalesce(F.json_object_keys("raw_data"), F.array().cast("array<string>")).alias("fields"),
        validate.failed_rules(rules).alias("reasons"),
    )


def parse_rss(df: DataFrame) -> DataFrame:
    """Feed entries (id, title, summary, link, published, categories) to parsed records."""
    link = F.coalesce(F.col("link"), F.lit(""))
    entry_id = F.coalesce(F.col("id"), link)
    title = F.coalesce(F.col("title"), F.lit(""))
    summary = F.coalesce(F.col("summary"), F.lit(""))
    published = S.safe_timestamp(F.col("published"))
    tags = F.coalesce(F.col("categories"), F.array().cast("array<string>"))
    raw = S.raw_json(
        entry_id.alias("id"), title.alias("title"), summary.alias("summary"), link.alias("link"),
        published.alias("published"), tags.alias("categories"),
    )
    broken = unreadable(df)
    given = {"id": "id", "title": "title", "summary": "summary", "link": "link", "published": "published"}
    return df.select(
        F.lit("rss").alias("source_type"),
        S.natural_source_id("rss", id=entry_id).alias("source_id"),
        title.alias("title"),
        summary.alias("description"),
        F.lit(None).cast("double").alias("value"),
        F.get(tags, F.lit(0)).alias("category"),
        tags.alias("tags"),
        published.alias("source_timestamp"),
        F.create_map(F.lit("link"), link).alias("extra_metadata"),
        identity(id=entry_id, link=link).alias("identity"),
        F.coalesce(broken, raw).alias("raw_data"),
        # The elements the entry really has, before any is defaulted.
        F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), n) for n, c in given.items()])).alias("fields"),
        validate.failed_rules({"malformed_xml": broken.isNotNull()} | validate.rss_rules(title, link)).alias("reasons"),
    )


def ticker_quote(record: Column) -> dict[str, Column]:
    """Unified fields of a provider that nests prices under ``quotes.USD``."""
    symbol = F.try_variant_get(record, "$.symbol", "string")
    return {
        "title": F.try_variant_get(record, "$.name", "string"),
        "description": F.concat_ws(
            " ", symbol, F.try_variant_get(record, "$.description", "string")
        ),
        "value": F.try_variant_get(record, "$.quotes.USD.price", "double"),
        "category": F.try_variant_get(record, "$.rank", "string"),
    }


def rank_bucket(rank: Column) -> Column:
    return F.when(rank <= 10, "top-10").when(rank <= 100, "top-100").when(
        rank.isNotNull(), "other"
    )


def market_quote(record: Column) -> dict[str, Column]:
    """Unified fields of a provider with flat market columns."""
    return {
        "title": F.try_variant_get(record, "$.name", "string"),
        "description": F.try_variant_get(record, "$.symbol", "string"),
        "value": F.try_variant_get(record, "$.current_price", "double"),
        "category": rank_bucket(F.try_variant_get(record, "$.market_cap_rank", "int")),
        "source_timestamp": S.safe_timestamp(
            F.try_variant_get(record, "$.last_updated", "string")
        ),
    }


def unify(feeds: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, feeds)


def to_records(parsed: DataFrame, created_at: Column, *kept: str) -> DataFrame:
    """Parsed records to rows of the unified table, and other columns to be kept."""
    have = set(parsed.columns)
    made = {
        "created_at": created_at.cast("timestamp"),
        "updated_at": F.lit(None).cast("timestamp"),
    }
    if "canonical_id" not in have:
        made["canonical_id"] = S.null_text()
    return parsed.select(
        *[
            made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in RECORDS.fields
        ],
        *kept,
    )


def public(records: DataFrame) -> DataFrame:
    return records.select(*PUBLIC_COLUMNS)
