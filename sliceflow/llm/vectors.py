"""Vectors in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, finite, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimensions(rows: DataFrame, vector: str) -> list[int]:
    """The lengths that the vectors of ``rows`` have."""
    return [r["d"] for r in rows.select(F.size(vector).alias("d")).distinct().orderBy("d").collect()]


def matrix(column, kind=np.float64) -> np.ndarray:
    """Rows of a list column whose vectors have equal lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0), dtype=kind)


def lists(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, d = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, np.int32)), pa.array(m.reshape(-1)))
