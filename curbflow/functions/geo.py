"""Distances: great-circle metres, and planar degrees from a point to a line piece."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: radius of the sphere on which driven metres are counted.
EARTH_RADIUS_METRES = 6371000


def haversine_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere.

    Also stands in for the geodesic distance of the location alert; the sphere
    is within 0.6 % of the ellipsoid.
    """
    half_lat = F.radians((lat1 - lat2) / 2)
    half_lon = F.radians((lon1 - lon2) / 2)
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    # Rounding can lift the term just above one for opposite points; null stays null.
    return F.lit(2.0 * EARTH_RADIUS_METRES) * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def point_to_piece_degrees(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance from point p to the straight piece from a to b (a = b allowed)."""
    dx, dy = bx - ax, by - ay
    squared = dx * dx + dy * dy
    along = F.coalesce(((px - ax) * dx + (py - ay) * dy) / F.nullif(squared, F.lit(0.0)), F.lit(0.0))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(px - (ax + clamped * dx), py - (ay + clamped * dy))


def grid_cell(value: Column, cell_size: float) -> Column:
    return F.floor(value / F.lit(cell_size))
