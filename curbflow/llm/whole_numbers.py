"""Vectors as whole numbers, as the exact clusterings use them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Whole numbers up to which squared distances of vectors of up to 1,000 components fit 64 bits.
LARGEST = 1 << 25


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))


def vectors(df: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """Rows (vec_id, vector of doubles, others) of the vectors that are there and whole."""
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), *(F.col(f"`{o}`").alias(o) for o in others)
    )
    return rows.where(finite(F.col("vector")))


def floors(column: pa.Array | pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, one row a vector. Numbers beyond LARGEST are an error, as distances would not fit."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return x.astype(np.int64).reshape(len(column), dim)
