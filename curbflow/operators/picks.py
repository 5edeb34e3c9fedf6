"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    Spark turns the ``row_number = 1`` filter into a group limit that runs
    before the shuffle as well, so a hot key sends one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")
