"""Repair of expected, actual and percentage of bin trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbflow.functions.numeric import percent_2dp
from curbflow.plans.lifting import BIN_LIFTED, STATUS_OF_CASE

# Geometry code of bins, completion type that counts whatever the status.
BIN_GEOMETRY = 1
MANUAL_COMPLETION = 2


def bin_trips(fleet) -> DataFrame:
    """Trips of services that work on bins: trip_id."""
    services = (
        fleet.services.join(
            fleet.service_geometry.where(F.col("geometry_type") == BIN_GEOMETRY).select("kind_id"),
            "kind_id", "left_semi",
        ).select(F.col("id").alias("service_id"))
    )
    plans = fleet.plans.join(services, "service_id", "left_semi").select(F.col("id").alias("plan_id"))
    return fleet.trips.join(plans, "plan_id", "left_semi").select(F.col("id").alias("trip_id"))


def fix_expected(fleet) -> DataFrame:
    """Trips with a complete summary (expected = actual) of which some summary expects another number than the planned stops: trip_id, expected.

    All summaries of such a trip are looked at, the others too. For each value expected by some of them a stop counts
    once per summary of its own and per summary of its trip with that value. Of several values that differ from
    their count the greatest count is kept.
    """
    complete = fleet.trip_summaries.where("expected_coverage = actual_coverage").select("trip_id")
    expecting = (
        fleet.trip_summaries.join(complete, "trip_id", "left_semi")
        .join(bin_trips(fleet), "trip_id", "left_semi")
        .groupBy("trip_id", "expected_coverage")
        .agg(F.count(F.lit(1)).alias("trip_rows"))
    )
    off_plan = F.coalesce(F.col("status_lookup").isin(STATUS_OF_CASE[3], STATUS_OF_CASE[4]), F.lit(False))
    # One pass over the summaries of a stop serves both the count and the exclusion.
    per_stop = (
        fleet.stop_summaries.groupBy("stop_id")
        .agg(F.count(F.lit(1)).alias("summaries"), F.bool_or(off_plan).alias("off_plan"))
        .where("not off_plan")
    )
    stops = fleet.stops.select(F.col("id").alias("stop_id"), "trip_id").join(
        expecting.select("trip_id"), "trip_id", "left_semi"
    )
    counted = stops.join(per_stop, "stop_id").groupBy("trip_id").agg(F.sum("summaries").alias("stop_rows"))
    return (
        expecting.join(counted, "trip_id")
        .withColumn("expected", F.col("stop_rows") * F.col("trip_rows"))
        .where("expected <> expected_coverage")
        .groupBy("trip_id")
        .agg(F.max("expected").alias("expected"))
    )


def fix_actual(fleet) -> DataFrame:
    """Lifted planned stops of every bin trip, once per summary of the trip: trip_id, actual."""
    counts = (
        (F.col("bin_status") == BIN_LIFTED)
        & ((F.col("status_lookup") == STATUS_OF_CASE[1]) | (F.col("completion_type") == MANUAL_COMPLETION))
        & (F.col("stop_order") >= 1)
    )
    per_trip = (
        fleet.stops.select(F.col("id").alias("stop_id"), "trip_id", "stop_order")
        .join(bin_trips(fleet), "trip_id", "left_semi")
        .join(fleet.stop_summaries.select("stop_id", "bin_status", "status_lookup", "completion_type"), "stop_id")
        .groupBy("trip_id")
        .agg(F.count_if(counts).alias("stop_rows"))
    )
    summaries = fleet.trip_summaries.groupBy("trip_id").agg(F.count(F.lit(1)).alias("trip_rows"))
    return per_trip.join(summaries, "trip_id").select("trip_id", (F.col("stop_rows") * F.col("trip_rows")).alias("actual"))


def fix_percentage(fleet) -> DataFrame:
    """Trip summaries with expected and actual repaired and the percentage of bin trips worked out anew."""
    repaired = (
        fleet.trip_summaries.join(fix_expected(fleet), "trip_id", "left")
        .join(fix_actual(fleet), "trip_id", "left")
        .join(bin_trips(fleet).withColumn("is_bin_trip", F.lit(True)), "trip_id", "left")
        .withColumns(
            {
                "expected_coverage": F.coalesce("expected", "expected_coverage"),
                "actual_coverage": F.coalesce(F.col("actual").cast("double"), F.col("actual_coverage")),
            }
        )
    )
    share = percent_2dp(F.col("actual_coverage"), F.col("expected_coverage"))
    capped = F.when(share > 100, F.lit(100)).otherwise(share).cast("double")
    return repaired.withColumn(
        "completion_pct", F.when(F.col("is_bin_trip"), capped).otherwise(F.col("completion_pct"))
    ).drop("expected", "actual", "is_bin_trip")
