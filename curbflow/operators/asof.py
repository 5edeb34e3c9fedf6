"""As-of join: the latest earlier row of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from curbflow.functions.time import time_slice


def last_before(
    moments: DataFrame,
    marks: DataFrame,
    key: str,
    moment_id: str,
    moment_time: str,
    mark_id: str,
    mark_time: str,
    slice_seconds: int = 3600,
) -> DataFrame:
    """(moment_id, mark_id) of the latest mark of the key strictly before the moment.

    Marks at the same time: the one with the greatest id. Nothing is paired:
    both sides go through one window per (key, slice of time). What a slice
    takes over from the slices before it comes from a second window that has
    one row per key and slice. Marks of keys nobody asks for are dropped first.
    """
    asked = moments.select(key).distinct()
    mark = F.struct(F.col(mark_time).alias("at"), F.col(mark_id).alias("id"))
    points = marks.where(F.col(mark_time).isNotNull()).join(asked, key, "left_semi").select(
        key,
        F.col(mark_time).alias("_at"),
        F.lit(1).alias("_kind"),
        mark.alias("_mark"),
        F.lit(None).cast(moments.schema[moment_id].dataType).alias(moment_id),
    )
    asks = moments.where(F.col(moment_time).isNotNull()).select(
        key,
        F.col(moment_time).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(points.schema["_mark"].dataType).alias("_mark"),
        moment_id,
    )
    both = asks.unionByName(points).withColumn("_slice", time_slice(F.col("_at"), slice_seconds))

    # Moments sort before marks of the same time, which makes "before" strict.
    in_slice = Window.partitionBy(key, "_slice").orderBy("_at", "_kind")
    in_slice = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_here", F.max("_mark").over(in_slice)).where("_kind = 0")

    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(key, "_slice")
        .agg(F.max("_mark").alias("_mark"))
        .select(key, "_slice", F.max("_mark").over(earlier).alias("_carried"))
        .where("_carried is not null")
    )
    return (
        found.join(carried, [key, "_slice"], "left")
        .select(moment_id, F.coalesce("_here", "_carried").alias("_mark"))
        .where("_mark is not null")
        .select(moment_id, F.col("_mark.id").alias(mark_id))
    )
