"""Previous row of a key in time order, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from curbflow.functions.time import time_slice


def previous_row(
    df: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    fields: Sequence[str],
    slice_seconds: int = 600,
) -> DataFrame:
    """Add struct ``previous`` with ``fields`` of the row before, per ``key``; null on the first row.

    The first window works per (key, slice of time), so a key that holds a large
    part of the rows spreads over its slices. The second links the slices of a
    key: there the first and last row of each slice form one group, at most two
    rows per slice, and all other rows stay in groups of their slice. ``df`` is
    read once; splitting the edges off and joining them back would run it twice.
    """
    payload = F.struct(*fields)
    in_slice = Window.partitionBy(key, "_slice").orderBy(time, *order)
    sliced = (
        df.withColumn("_slice", time_slice(F.col(time), slice_seconds))
        .withColumn("previous", F.lag(payload).over(in_slice))
        .withColumn("_last", F.lead(F.lit(1)).over(in_slice).isNull())
    )
    is_edge = F.col("previous").isNull() | F.col("_last")
    across = Window.partitionBy(key, "_link").orderBy(time, *order)
    # The last row of a slice keeps what the slice window found; the first takes the edge before it.
    return (
        sliced.withColumn("_link", F.when(~is_edge, F.col("_slice")))
        .withColumn("previous", F.coalesce("previous", F.lag(payload).over(across)))
        .drop("_slice", "_last", "_link")
    )
