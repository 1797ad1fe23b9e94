"""Similarity of two field names."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def name_similarity(left: str, right: str) -> Column:
    """Matching-block ratio of two name columns. Spark has no built-in with these values.

    Callers pass distinct pairs only, so its cost follows the number of different field
    names and not the number of records. The function is local so that it travels to the
    executors by value.
    """

    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(ratios, T.DoubleType())(left, right)
