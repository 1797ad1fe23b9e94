"""Helpers for embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as doubles; all are of one length."""
    rows = len(column)
    if not rows:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def sample(vectors: DataFrame, most: int, id_col: str, vec_col: str) -> np.ndarray:
    """At most ``most`` vectors, chosen by a hash of their id."""
    picked = vectors.orderBy(F.xxhash64(id_col), id_col).limit(most).select(vec_col).toArrow().combine_chunks()
    if not picked.num_rows:
        return np.zeros((0, 0))
    column = picked.column(0)
    return matrix(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
