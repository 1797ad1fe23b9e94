"""Conversions and ids as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace in the Unicode sense, as a character class both Java and RE2 understand.
SPACE_CLASS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
# The same characters as plain text, for trim().
SPACE_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
    + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf(?:inity)?))\s*$"

_ISO = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[T ].*)?\s*$"
_WEEKDAY = r"^(?:Mon|Tue|Tues|Wed|Thu|Thur|Thurs|Fri|Sat|Sun)(?:day|nesday|sday|urday)?,?\s+"
# Declared formats beyond ISO 8601; anything else is null.
TIMESTAMP_FORMATS = [
    "yyyy-M-d'T'HH:mm[XXX]",
    "yyyy-M-d HH:mm[XXX]",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy[ HH:mm[:ss]]",
    "d MMMM yyyy[ HH:mm[:ss]]",
    "MMM d, yyyy[ HH:mm[:ss]]",
    "MMMM d, yyyy[ HH:mm[:ss]]",
    "M/d/yyyy[ HH:mm[:ss]]",
    "yyyy/M/d[ HH:mm[:ss]]",
    "yyyyMMdd",
    "yyyyMMdd'T'HHmmss[X]",
]


def null_text() -> Column:
    return F.lit(None).cast("string")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE_CHARS))


def truncate(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def safe_float(text: Column) -> Column:
    """Text to double; null for null, empty, NaN and anything that is not a number."""
    number = F.regexp_replace(text, "_", "").try_cast("double")
    return F.when(text.rlike(_NUMBER), number)


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike(_NUMBER), F.lit(False))


def safe_timestamp(text: Column) -> Column:
    """Text to timestamp in the declared formats; naive times are UTC, others null."""
    bare = F.regexp_replace(strip(text), _WEEKDAY, "")
    parsed = [F.try_to_timestamp(bare, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS]
    return F.when(text.rlike(_ISO), F.coalesce(text.try_cast("timestamp"), *parsed[:2])).otherwise(
        F.coalesce(*parsed[2:])
    )


def natural_source_id(
    prefix: Column | str,
    id: Column | None = None,
    guid: Column | None = None,
    link: Column | None = None,
    content: Column | None = None,
    present: Mapping[str, Column] | None = None,
) -> Column:
    """``prefix_id``, else ``prefix_guid``, else a short hash of link or content.

    The first *present* field decides. ``present`` says per field whether a record carries
    it; without it a field counts as present when it is not null.
    """
    head = F.lit(prefix) if isinstance(prefix, str) else prefix

    def joined(tail: Column) -> Column:
        return F.concat(head, F.lit("_"), F.coalesce(tail, F.lit("None")))

    def short_hash(text: Column) -> Column:
        return joined(F.substring(F.md5(text), 1, 16))

    out = short_hash(content) if content is not None else null_text()
    options = [("link", link, short_hash), ("guid", guid, joined), ("id", id, joined)]
    for name, value, shape in options:
        if value is not None:
            given = value.isNotNull() if present is None else present[name]
            out = F.when(given, shape(value)).otherwise(out)
    return out


def content_text(fields: Mapping[str, Column]) -> Column:
    """A record's content with its fields in name order, ready to be hashed."""
    parts = [fields[name].cast("string").alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def sorted_json(raw: Column) -> Column:
    """A JSON object with its top-level keys in order (variants keep keys sorted)."""
    return F.to_json(F.try_parse_json(raw))


def raw_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def first_present(options: list[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first field the record carries, even when that value is null.

    ``options`` holds (is the field there, its value) in the order they are tried.
    """
    out = default
    for given, value in reversed(options):
        out = F.when(given, value).otherwise(out)
    return out


def run_id(started_at: Column, key: Column) -> Column:
    """``run_YYYYmmdd_HHMMSS_xxxxxxxx``, with a hash tail so that a retry names the same run."""
    stamp = F.date_format(started_at, "yyyyMMdd_HHmmss")
    return F.concat(F.lit("run_"), stamp, F.lit("_"), F.substring(F.md5(key), 1, 8))


def elapsed_seconds(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)
