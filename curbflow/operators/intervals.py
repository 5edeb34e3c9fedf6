"""Join moments to the intervals that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbflow.functions.time import time_slice

# A block of one level is so many blocks of the level below, as a power of two.
LEVEL_BITS = 2


def block_of(slice_no: Column, level: Column) -> Column:
    """The block of a level that holds a slice."""
    return F.call_function("shiftright", slice_no, level * LEVEL_BITS)


def time_blocks(first: Column, last: Column) -> Column:
    """Blocks (level, block) that cover the slices from ``first`` to ``last`` exactly, as an array of structs.

    A block of level k is 4^k slices and starts at a multiple of that. An interval of n slices has at most 6 blocks a
    level and 7 on its top level, and its top level is below log4(n); up to 4 slices are all of level 0.
    """

    def with_top(bounds: Column) -> Column:
        low, end, top = bounds["low"], bounds["end"], bounds["top"]
        # Whole blocks of a level: [from_, to).
        from_ = lambda level: -block_of(-low, level)
        to = lambda level: block_of(end, level)

        def of_level(level: Column) -> Column:
            step = 1 << LEVEL_BITS
            run = lambda start, stop: F.when(start < stop, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))
            whole = run(from_(level), to(level))
            sides = F.concat(run(from_(level), from_(level + 1) * step), run(to(level + 1) * step, to(level)))
            blocks = F.when(level == top, whole).otherwise(sides)
            return F.transform(blocks, lambda block: F.struct(level.cast("int").alias("level"), block.alias("block")))

        return F.flatten(F.transform(F.sequence(F.lit(0), top), of_level))

    # Levels are halves of the bits of a count, as a level has two.
    bits = F.length(F.bin(last - first))
    top = F.greatest(F.lit(0), F.ceil(bits / LEVEL_BITS).cast("int") - 1)
    bounds = F.struct(first.cast("bigint").alias("low"), (last + 1).cast("bigint").alias("end"), top.alias("top"))
    return F.element_at(F.transform(F.array(bounds), with_top), 1)


def covering(
    moments: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    start: str,
    end: str,
    slice_seconds: int = 4 * 3600,
    closed_end: bool = False,
) -> DataFrame:
    """Rows of ``moments`` with every interval of the same ``key`` in [start, end).

    An interval is repeated once per block of time that covers it (see :func:`time_blocks`), however long it is. A
    moment looks into one block of each level that intervals of its key have; with intervals of a few slices that
    is one. Only rows that share a block are compared, and a hot key is spread over its blocks. Moments without an
    interval of their key are dropped first. Column names of both sides must differ except for ``key``.
    """
    first, last = time_slice(F.col(start), slice_seconds), time_slice(F.col(end), slice_seconds)
    blocks = intervals.where(F.col(start) <= F.col(end)).withColumn("_at", F.explode(time_blocks(first, last)))
    blocks = blocks.withColumns({"_level": F.col("_at.level"), "_block": F.col("_at.block")}).drop("_at")
    levels = blocks.select(key, "_level").distinct()
    upper: Column = F.col(time) <= F.col(end) if closed_end else F.col(time) < F.col(end)
    return (
        moments.join(levels, key)
        .withColumn("_block", block_of(time_slice(F.col(time), slice_seconds), F.col("_level")))
        .join(blocks, [key, "_level", "_block"])
        .where((F.col(time) >= F.col(start)) & upper)
        .drop("_level", "_block")
    )
