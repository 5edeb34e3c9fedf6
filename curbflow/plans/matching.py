"""Match tag reads to planned stops: seven cases, each read goes to the first that takes it.

    1  the tag is a stop of a trip its vehicle is on at that moment (both ends included)
    2  the tag is a stop of a trip of its vehicle that has ended; the latest such trip
    3  its vehicle is on a trip at that moment, and the tag is not a stop of that trip
    4  its vehicle's latest ended trip does not have the tag
    5  the tag is a stop of a trip another vehicle is on at that moment
    6  the tag is a stop of an ended trip of another vehicle; the latest
    7  the tag is a stop of no trip

Reads are one per tag, so a join on the tag has at most as many rows as the
stops have, however often one tag is planned. Joins on the vehicle go through
slices of time (see ``operators``). Ties: the later start (3, 5) or end
(2, 4, 6) wins, then the greater trip id, then the greater stop id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from curbflow.functions.text import tag_key
from curbflow.operators import covering, first_per, last_before

READ = ("ping_id", "tag_key", "vehicle_id", "movement_time")
MATCH = ("ping_id", "case_no", "trip_id", "stop_id", "summary_id")


def reads_of(lifts: DataFrame) -> DataFrame:
    return lifts.select(F.col("id").alias("ping_id"), "tag_key", "vehicle_id", "movement_time")


def live_trips(trips: DataFrame) -> DataFrame:
    return trips.where(~F.col("is_deleted")).select(
        F.col("id").alias("trip_id"), F.col("vehicle_id").alias("trip_vehicle"), "start_trip", "end_trip"
    )


def tag_hits(lifts: DataFrame, stops: DataFrame, trips: DataFrame) -> DataFrame:
    """Reads with every stop that has their tag, and the vehicle and window of its trip.

    The window is null where the trip is deleted or missing: such a stop still
    counts as having the tag. The one join with the stop table; every case
    starts from it, so settle it (:func:`curbflow.session.cut_lineage`) first.
    """
    planned = stops.where(F.col("tag").isNotNull()).select(
        tag_key(F.col("tag")).alias("tag_key"), F.col("id").alias("stop_id"), "trip_id"
    )
    return reads_of(lifts).join(planned, "tag_key").join(live_trips(trips), "trip_id", "left")


def _summaries(stop_summaries: DataFrame) -> DataFrame:
    return stop_summaries.select("stop_id", F.col("id").alias("summary_id"))


def _match(df: DataFrame, case_no: int) -> DataFrame:
    """Bring a case to the common columns."""
    absent = F.lit(None).cast("long")
    return df.select(
        "ping_id",
        F.lit(case_no).alias("case_no"),
        *(F.col(name) if name in df.columns else absent.alias(name) for name in MATCH[2:]),
    )


# How a read lies to a trip; plain SQL conditions on the columns of a tag hit.
SAME = "trip_vehicle = vehicle_id"
OTHER = "trip_vehicle <> vehicle_id"
INSIDE = "start_trip <= movement_time and movement_time < end_trip"
INSIDE_OR_AT_END = "start_trip <= movement_time and movement_time <= end_trip"
ENDED = "end_trip < movement_time"


def on_plan(hits: DataFrame, stop_summaries: DataFrame) -> DataFrame:
    """Case 1: every match of the read, one per stop summary."""
    inside = hits.where(f"{SAME} and {INSIDE_OR_AT_END}")
    return _match(inside.join(_summaries(stop_summaries), "stop_id"), 1)


def late_on_plan(hits: DataFrame, stop_summaries: DataFrame) -> DataFrame:
    """Case 2: the stop of the latest ended trip, chosen before its summary is looked up."""
    latest = (
        hits.where(f"{SAME} and {ENDED}")
        .groupBy("ping_id")
        .agg(F.max(F.struct("end_trip", "trip_id", "stop_id")).alias("best"))
        .select("ping_id", "best.trip_id", "best.stop_id")
    )
    return _match(latest.join(_summaries(stop_summaries), "stop_id"), 2)


def _without_tag(picked: DataFrame, hits: DataFrame) -> DataFrame:
    """Drop picks whose trip has the tag; the hits already hold every (read, trip) with it."""
    return picked.join(hits.select("ping_id", "trip_id"), ["ping_id", "trip_id"], "left_anti")


def off_plan(lifts: DataFrame, hits: DataFrame, trips: DataFrame) -> DataFrame:
    """Case 3: the vehicle's trip at that moment, [start, end)."""
    windows = live_trips(trips).withColumnRenamed("trip_vehicle", "vehicle_id")
    inside = covering(reads_of(lifts), windows, "vehicle_id", "movement_time", "start_trip", "end_trip")
    picked = first_per(
        inside.select("ping_id", "trip_id", "start_trip"), ["ping_id"], [F.desc("start_trip"), F.desc("trip_id")]
    )
    return _match(_without_tag(picked, hits), 3)


def late_off_plan(lifts: DataFrame, hits: DataFrame, trips: DataFrame) -> DataFrame:
    """Case 4: the vehicle's latest ended trip; whether it has the tag is asked after the pick."""
    ends = live_trips(trips).withColumnRenamed("trip_vehicle", "vehicle_id")
    picked = last_before(
        reads_of(lifts), ends, "vehicle_id", "ping_id", "movement_time", "trip_id", "end_trip"
    )
    return _match(_without_tag(picked, hits), 4)


def other_vehicle(hits: DataFrame) -> DataFrame:
    """Case 5: the trip of another vehicle with the tag, [start, end)."""
    picked = (
        hits.where(f"{OTHER} and {INSIDE}")
        .groupBy("ping_id")
        .agg(F.max(F.struct("start_trip", "trip_id", "stop_id")).alias("best"))
        .select("ping_id", "best.trip_id", "best.stop_id")
    )
    return _match(picked, 5)


def other_vehicle_late(hits: DataFrame) -> DataFrame:
    """Case 6: the latest ended trip of another vehicle with the tag."""
    picked = (
        hits.where(f"{OTHER} and {ENDED}")
        .groupBy("ping_id")
        .agg(F.max(F.struct("end_trip", "trip_id", "stop_id")).alias("best"))
        .select("ping_id", "best.trip_id", "best.stop_id")
    )
    return _match(picked, 6)


def unplanned(lifts: DataFrame, hits: DataFrame) -> DataFrame:
    """Case 7: reads whose tag is a stop of no trip."""
    return _match(reads_of(lifts).join(hits.select("ping_id"), "ping_id", "left_anti"), 7)


def match_lifts(lifts: DataFrame, hits: DataFrame, trips: DataFrame, stop_summaries: DataFrame) -> DataFrame:
    """All reads with their case: ping_id, case_no, trip_id, stop_id, summary_id.

    All cases are found side by side; the least case number per read is kept.
    A read has several rows in case 1 (and 2) if it matches several summaries,
    and none if no case takes it. Cases 5 and 6 name a stop too; they have no summary.
    """
    candidates = (
        on_plan(hits, stop_summaries)
        .unionByName(late_on_plan(hits, stop_summaries))
        .unionByName(off_plan(lifts, hits, trips))
        .unionByName(late_off_plan(lifts, hits, trips))
        .unionByName(other_vehicle(hits))
        .unionByName(other_vehicle_late(hits))
        .unionByName(unplanned(lifts, hits))
    )
    by_case = Window.partitionBy("ping_id").orderBy("case_no")
    return candidates.withColumn("_rank", F.dense_rank().over(by_case)).where("_rank = 1").drop("_rank")


def with_ping(matches: DataFrame, lifts: DataFrame) -> DataFrame:
    """Matches with the columns of their read."""
    return matches.join(lifts.withColumnRenamed("id", "ping_id"), "ping_id")
