"""Join points to the lines within a small distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from curbflow.functions.geo import grid_cell, point_to_piece_degrees

CELLS_PER_TOLERANCE = 4
# A piece of a line lies in at most about so many columns and rows of cells of its size.
CELLS_PER_PIECE = 8
# The type of a line's cells: level, column and row of the cell, both ends of the piece.
CELLS_TYPE = "array<struct<level:int,cx:bigint,cy:bigint,ax:double,ay:double,bx:double,by:double>>"


def cell_size(level: Column, tolerance: float) -> Column:
    """Cells of a level are twice as wide as those of the level below."""
    return F.lit(tolerance * CELLS_PER_TOLERANCE) * F.pow(F.lit(2.0), level)


def cells_of_line(line: Column, tolerance: float) -> Column:
    """The cells near each straight piece of a line, as ``CELLS_TYPE``.

    ``line`` is an array of lon/lat points; one point makes one piece of no length. All cells of a line have one size,
    which fits its longest piece, and only those beside a piece are taken, so a piece has tens of cells however long it
    is. The cells are a matter of the line alone: they can be stored with it.
    """
    # A little over the tolerance, so that rounding loses no pair.
    margin = F.lit(tolerance * 1.01)
    tail = F.when(F.size(line) > 1, F.slice(line, F.lit(2), F.size(line))).otherwise(line)
    head = F.when(F.size(line) > 1, F.slice(line, F.lit(1), F.size(line) - 1)).otherwise(line)
    span = lambda low, high, cell: F.sequence(F.floor((low - margin) / cell), F.floor((high + margin) / cell))

    smallest = CELLS_PER_PIECE * CELLS_PER_TOLERANCE * tolerance
    extents = F.zip_with(head, tail, lambda a, b: F.greatest(F.abs(b["lon"] - a["lon"]), F.abs(b["lat"] - a["lat"])))
    longest = F.greatest(F.array_max(extents), F.lit(smallest))
    level = F.ceil(F.log2(longest / smallest)).cast("int")

    def piece(a: Column, b: Column) -> Column:
        return F.struct(a["lon"].alias("ax"), a["lat"].alias("ay"), b["lon"].alias("bx"), b["lat"].alias("by"))

    def cells(p: Column, level: Column) -> Column:
        ax, ay, bx, by = (p[name] for name in ("ax", "ay", "bx", "by"))
        cell = cell_size(level, tolerance)

        # Within a column of cells only the rows beside the piece, not its whole box.
        def height(x: Column) -> Column:
            along = F.coalesce((x - ax) / F.nullif(bx - ax, F.lit(0.0)), F.lit(0.0))
            return ay + F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)) * (by - ay)

        def rows(cx: Column) -> Column:
            left, right = height(cx * cell - margin), height((cx + 1) * cell + margin)
            low = F.when(ax == bx, F.least(ay, by)).otherwise(F.least(left, right))
            high = F.when(ax == bx, F.greatest(ay, by)).otherwise(F.greatest(left, right))
            return F.transform(
                span(low, high, cell),
                lambda cy: F.struct(level.alias("level"), cx.alias("cx"), cy.alias("cy"), ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by")),
            )

        return F.flatten(F.transform(span(F.least(ax, bx), F.greatest(ax, bx), cell), rows))

    on_level = lambda level: F.flatten(F.transform(F.zip_with(head, tail, piece), lambda p: cells(p, level)))
    return F.element_at(F.transform(F.array(level), on_level), 1).cast(CELLS_TYPE)


def line_cells(lines: DataFrame, line_id: str, line: str, tolerance: float, stored: str | None = None) -> DataFrame:
    """(line_id, level, cx, cy, pieces): the straight pieces of each line near each cell.

    Work is per line, so it is done before lines meet trips or pings. ``stored`` names a column that may hold
    the cells (see :func:`cells_of_line`); where it is null they are worked out.
    """
    cells = cells_of_line(F.col(line), tolerance)
    if stored is not None:
        cells = F.coalesce(F.col(stored).cast(CELLS_TYPE), cells)
    placed = lines.select(line_id, F.explode(cells).alias("at"))
    # At most the vertices of one line, which were one array to begin with.
    pieces = F.collect_list(F.struct(*(F.col(f"at.{name}") for name in ("ax", "ay", "bx", "by")))).alias("pieces")
    return placed.groupBy(line_id, *(F.col(f"at.{name}").alias(name) for name in ("level", "cx", "cy"))).agg(pieces)


def near_lines(
    points: DataFrame, cells: DataFrame, keys: Sequence[str], lon: str, lat: str, tolerance: float
) -> DataFrame:
    """Points with each line within ``tolerance`` degrees; column ``distance`` is the exact distance.

    ``cells`` comes from :func:`line_cells`, joined to whatever ``keys`` it is matched on. A point looks into one cell
    of each level that its keys have, and points whose keys have none are dropped first. One equi-join on (keys, level,
    cell); one row per point and line.
    """
    if not keys:
        nothing = F.lit(0)
        return near_lines(points.withColumn("_all", nothing), cells.withColumn("_all", nothing), ["_all"], lon, lat, tolerance).drop("_all")
    placed = points.join(cells.select(*keys, "level").distinct(), list(keys))
    size = cell_size(F.col("level"), tolerance)
    placed = placed.withColumns({"cx": F.floor(F.col(lon) / size), "cy": F.floor(F.col(lat) / size)})
    distance = F.array_min(
        F.transform(
            "pieces", lambda p: point_to_piece_degrees(F.col(lon), F.col(lat), p["ax"], p["ay"], p["bx"], p["by"])
        )
    )
    near = placed.join(cells, [*keys, "level", "cx", "cy"]).withColumn("distance", distance)
    return near.where(F.col("distance") <= F.lit(tolerance)).drop("level", "cx", "cy", "pieces")
