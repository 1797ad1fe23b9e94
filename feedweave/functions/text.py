"""Text shapes that identities are read from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedweave.functions.scalars import SPACE_CLASS

SLUG_LENGTH = 100
COIN_URL = r"/coins?/([a-z0-9-]+)"
PAREN_SYMBOL = r"\(([A-Z]{2,6})\)"


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def slug(title: Column) -> Column:
    """Lower-case words joined by single hyphens, at most 100 characters."""
    words = F.regexp_replace(F.lower(title), rf"[^\p{{L}}\p{{N}}_{SPACE_CLASS}-]", "")
    dashed = F.regexp_replace(words, rf"[{SPACE_CLASS}-]+", "-")
    cut = F.substring(F.trim(dashed, F.lit("-")), 1, SLUG_LENGTH)
    return F.when(title.isNotNull(), F.coalesce(_or_null(cut), F.lit("unknown")))


def paren_symbol(title: Column) -> Column:
    """``BTC`` from ``Bitcoin (BTC)``."""
    return _or_null(F.regexp_extract(title, PAREN_SYMBOL, 1))


def url_slug(url: Column, pattern: str = COIN_URL) -> Column:
    return F.get(F.regexp_extract_all(F.lower(url), F.lit(pattern), F.lit(1)), F.lit(0))
