"""Null-safe arithmetic; ANSI mode raises on a plain division by zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null where ``bottom`` is zero."""
    return top / F.nullif(bottom, F.lit(0))


def at_most_hundred(value: Column) -> Column:
    """Cap at 100 and keep null as null (``least`` would skip it)."""
    return F.when(value > 100, F.lit(100.0)).otherwise(value)


def percent_2dp(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` rounded half up to two places; null where ``whole`` is zero."""
    exact = part.cast("decimal(18,6)") * 100 / F.nullif(whole.cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return exact.cast("decimal(18,2)")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(value * weight) / sum(weight); null where the weights sum to zero."""
    return ratio(F.sum(value * weight), F.sum(weight))
