"""What matching needs of trips that have ended, kept as small tables that each batch brings up to date.

For reads at or after the clock ``as_of`` three tables stand for all trips that ended before it:

    vehicle_history  the latest ended trip of each vehicle
    tag_history      the latest ended trip of each vehicle that had the tag, and its stop
    known_tags       every tag that was ever a stop

With the trips that ended since and their stops they give the same matches as the whole tables do: a late case asks
for the latest ended trip, which is one that ended since or the one kept; a vehicle's latest trip has a tag if it is
also the latest trip of that vehicle with the tag. Reads before ``as_of`` need the whole tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from curbflow.functions.text import tag_key
from curbflow.functions.time import date_lit, timestamp_lit
from curbflow.plans.matching import reads_of, tag_hits

# The day of a trip's end, by which the tables of trips are stored.
TRIP_DAY = "trip_day"
TABLES = ("vehicle_history", "tag_history", "known_tags", "history_clock")


def live(trips: DataFrame) -> DataFrame:
    """Trips that can be a vehicle's latest."""
    return trips.where(~F.col("is_deleted") & F.col("vehicle_id").isNotNull() & F.col("end_trip").isNotNull())


def by_vehicle(trips: DataFrame) -> DataFrame:
    """(vehicle_id, end_trip, trip_id) of the latest of the given trips."""
    last = F.max(F.struct("end_trip", F.col("id").alias("trip_id"))).alias("last")
    return live(trips).groupBy("vehicle_id").agg(last).select("vehicle_id", "last.*")


def by_tag(stops: DataFrame, trips: DataFrame) -> DataFrame:
    """(tag_key, vehicle_id, end_trip, trip_id, stop_id) of the latest of the given trips with the tag."""
    ends = live(trips).select(F.col("id").alias("trip_id"), "vehicle_id", "end_trip")
    tagged = stops.where(F.col("tag").isNotNull()).select(tag_key(F.col("tag")).alias("tag_key"), F.col("id").alias("stop_id"), "trip_id")
    last = F.max(F.struct("end_trip", "trip_id", "stop_id")).alias("last")
    return tagged.join(ends, "trip_id").groupBy("tag_key", "vehicle_id").agg(last).select("tag_key", "vehicle_id", "last.*")


def tags_of(stops: DataFrame) -> DataFrame:
    return stops.where(F.col("tag").isNotNull()).select(tag_key(F.col("tag")).alias("tag_key")).distinct()


def clock_row(spark, as_of: dt.datetime) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("id"), timestamp_lit(as_of).alias("as_of"))


def first_history(fleet, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The tables from all trips and stops."""
    ended = fleet.trips.where(F.col("end_trip") < timestamp_lit(as_of))
    return {
        "vehicle_history": by_vehicle(ended),
        "tag_history": by_tag(fleet.stops, ended),
        "known_tags": tags_of(fleet.stops),
        "history_clock": clock_row(fleet.trips.sparkSession, as_of),
    }


def since(table: DataFrame, moment: dt.datetime) -> DataFrame:
    """Rows of a table of trips whose trip ended on the day of ``moment`` or later, or has no known end."""
    if TRIP_DAY not in table.columns:
        return table
    return table.where(F.col(TRIP_DAY).isNull() | (F.col(TRIP_DAY) >= date_lit(moment.date())))


@dataclass
class History:
    as_of: dt.datetime
    vehicles: DataFrame
    tags: DataFrame
    known: DataFrame

    def recent(self, trips: DataFrame) -> DataFrame:
        """Trips that ended at ``as_of`` or later."""
        return since(trips, self.as_of).where(F.col("end_trip") >= timestamp_lit(self.as_of))

    def trips(self, trips: DataFrame) -> DataFrame:
        """Recent trips, and of each vehicle the latest that ended before; the start of those isn't known and matches nothing."""
        columns = ["id", "vehicle_id", "start_trip", "end_trip", "is_deleted"]
        kept = self.vehicles.select(
            F.col("trip_id").alias("id"), "vehicle_id", F.lit(None).cast("timestamp_ntz").alias("start_trip"), "end_trip", F.lit(False).alias("is_deleted")
        )
        return self.recent(trips).select(*columns).unionByName(kept)

    def hits(self, lifts: DataFrame, stops: DataFrame, trips: DataFrame) -> DataFrame:
        """What :func:`curbflow.plans.matching.tag_hits` gives, as far as the cases look at it."""
        recent = self.recent(trips)
        held = since(stops, self.as_of).join(recent.select(F.col("id").alias("trip_id")), "trip_id", "left_semi")
        found = tag_hits(lifts, held, recent)
        reads = reads_of(lifts)
        kept = self.tags.select("tag_key", F.col("vehicle_id").alias("trip_vehicle"), "end_trip", "trip_id", "stop_id")
        earlier = reads.join(kept, "tag_key").withColumn("start_trip", F.lit(None).cast("timestamp_ntz"))
        # A tag that was ever a stop is no unplanned one.
        known = reads.join(self.known.select("tag_key"), "tag_key", "left_semi")
        return found.unionByName(earlier).unionByName(known, allowMissingColumns=True)

    def changes(self, now: dt.datetime, trips: DataFrame, stops: DataFrame, added_stops: DataFrame, their_trips: DataFrame) -> dict[str, DataFrame]:
        """Rows of the tables that change as the clock goes on to ``now``.

        ``stops`` are those stored, ``added_stops`` those of this run, on ``their_trips`` (which may have ended long ago).
        """
        now = max(now, self.as_of)
        ended = self.recent(trips).where(F.col("end_trip") < timestamp_lit(now))
        held = since(stops, self.as_of)
        columns = ["id", "trip_id", "tag"]
        newly = by_tag(held.select(*columns).unionByName(added_stops.select(*columns)), ended)
        late = by_tag(added_stops, their_trips.where(F.col("end_trip") < timestamp_lit(now)))
        found = newly.unionByName(late)
        last = F.struct("end_trip", "trip_id", "stop_id")
        touched = self.tags.join(found.select("tag_key", "vehicle_id").distinct(), ["tag_key", "vehicle_id"], "left_semi")
        found = found.unionByName(touched.select(*found.columns)).groupBy("tag_key", "vehicle_id").agg(F.max(last).alias("last"))
        return {
            "vehicle_history": by_vehicle(ended),
            "tag_history": found.select("tag_key", "vehicle_id", "last.*"),
            "known_tags": tags_of(added_stops).join(self.known, "tag_key", "left_anti"),
            "history_clock": clock_row(trips.sparkSession, now),
        }
