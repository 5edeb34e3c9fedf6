"""Consecutive numbers in a given order, over a whole table or per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from curbflow.session import cut_lineage

# ``monotonically_increasing_id`` keeps the partition number above this many bits.
PARTITION_SHIFT = 33


def consecutive_numbers(
    df: DataFrame, order: Sequence[str], name: str, start: int = 1, keys: Sequence[str] = ()
) -> DataFrame:
    """Number the rows from ``start`` in ``order``, within each key if ``keys`` are given.

    Rows are range-partitioned by keys and order and written to the checkpoint
    folder, which settles the partition of a row. Each partition is numbered by
    itself; counts per partition (and key) give it its offset. No task sees more
    than a partition, even if one key holds most rows.
    """
    ranged = df.repartitionByRange(*keys, *order)
    placed = cut_lineage(ranged.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), PARTITION_SHIFT)))
    here = Window.partitionBy("_part", *keys).orderBy(*order)
    placed = placed.withColumn("_row", F.row_number().over(here))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part", *keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    return (
        placed.join(offsets, ["_part", *keys])
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(start - 1))
        .drop("_part", "_row", "_offset")
    )
