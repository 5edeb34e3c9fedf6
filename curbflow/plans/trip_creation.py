"""Expand plans into dated trips with their summaries, stops, texts and crews."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window, functions as F

from curbflow.functions.keys import derived_key
from curbflow.functions.text import tag_hash, tag_key
from curbflow.functions.time import (
    date_lit,
    days_until_weekday,
    on_day,
    seconds_of_day,
    timestamp_lit,
    weekday_index,
    weekday_index_of,
)
from curbflow.operators import consecutive_numbers
from curbflow.plans.history import since
from curbflow.session import cut_lineage

# Starts kept per weekly plan, trip and summary states, defaults of new rows, text format.
WEEKLY_STARTS = 2
TRIP_PLANNED, TRIP_STARTED = 1, 3
STARTS_BEFORE = dt.timedelta(hours=1)
NEW_SUMMARY_STATUS, NEW_DISCHARGE_STATUS = 5, 2
NEW_BIN_STATUS, NEW_COMPLETION_TYPE = 1, 1
REFERENCE_PREFIX = "TRI"
TEXT_TIME_FORMAT = "yyyy-MM-dd hh:mm"


def plans_due(fleet, today: dt.date) -> DataFrame:
    """Plans that may start trips on ``today``.

    Created by then, run on this weekday or monthly, with month days or any
    weekday, with stops, not deleted. A service with several contract details
    gives the plan as many rows, told apart by ``plan_copy``.
    """
    days = (
        fleet.plan_days.select(F.col("plan_id").alias("id"), F.col("weekday_id"))
        .join(fleet.weekdays.select(F.col("id").alias("weekday_id"), "day"), "weekday_id", "left")
        .groupBy("id")
        .agg(F.bool_or(F.coalesce(F.col("day") == weekday_index_of(today), F.lit(False))).alias("runs_today"))
    )
    has_days = F.col("runs_today").isNotNull()
    listed = F.col("is_monthly") & F.col("monthly_days").isNotNull()
    return (
        fleet.plans.where(~F.col("is_deleted") & (F.col("created_date").cast("date") <= date_lit(today)))
        .join(days, "id", "left")
        .where((F.coalesce("runs_today", F.lit(False)) | F.col("is_monthly")) & (listed | has_days))
        .join(fleet.plan_details.select(F.col("plan_id").alias("id")), "id", "left_semi")
        .join(fleet.contract_details.select("service_id"), "service_id")
        .drop("runs_today")
        .withColumn("plan_copy", F.row_number().over(Window.partitionBy("id").orderBy("service_id")))
    )


def weekly_starts(due: DataFrame, fleet, today: dt.date, now: dt.datetime) -> DataFrame:
    """Next two weekdays of each weekly plan; today's is dropped after the pick if its hour has passed."""
    weekly = due.where(~F.col("is_monthly"))
    offsets = (
        fleet.plan_days.where(~F.col("is_deleted"))
        .join(fleet.weekdays.select(F.col("id").alias("weekday_id"), "day"), "weekday_id")
        .join(weekly.select(F.col("id").alias("plan_id")), "plan_id", "left_semi")
        .select("plan_id", days_until_weekday(F.col("day"), today).alias("offset"))
    )
    place = F.row_number().over(Window.partitionBy("plan_id").orderBy("offset"))
    nearest = offsets.withColumn("_place", place).where(f"_place <= {WEEKLY_STARTS}").drop("_place")
    still_ahead = seconds_of_day(F.col("start_date")) >= seconds_of_day(timestamp_lit(now))
    return (
        weekly.select(F.col("id").alias("plan_id"), "start_date")
        .join(nearest, "plan_id")
        .where((F.col("offset") > 0) | still_ahead)
        .select("plan_id", on_day(F.date_add(date_lit(today), F.col("offset").cast("int")), F.col("start_date")).alias("start_trip"))
    )


def monthly_starts(due: DataFrame, today: dt.date) -> DataFrame:
    """Listed days of this month from today on; a day the month does not have gives no start."""
    day = F.trim("day_text").try_cast("int")
    return (
        due.where("is_monthly")
        .select(F.col("id").alias("plan_id"), "start_date", F.explode(F.split("monthly_days", ",")).alias("day_text"))
        .where(day >= today.day)
        .select(
            "plan_id",
            F.try_make_timestamp_ntz(
                F.lit(today.year), F.lit(today.month), day,
                F.hour("start_date"), F.minute("start_date"), F.second("start_date").cast("decimal(16,6)"),
            ).alias("start_trip"),
        )
        .where("start_trip is not null")
    )


def existing_trips(starts: DataFrame, trips: DataFrame) -> DataFrame:
    """Live trips at the same plan and start, one row per start and trip."""
    live = trips.where(~F.col("is_deleted")).select("plan_id", "start_trip", F.col("id").alias("trip_id"))
    return starts.join(live, ["plan_id", "start_trip"])


def trips_to_create(starts: DataFrame, existing: DataFrame) -> DataFrame:
    return starts.join(existing.select("plan_id", "start_trip"), ["plan_id", "start_trip"], "left_anti")


@dataclass
class Kept:
    """What trip creation keeps from run to run, so that no run counts or joins all trips.

    ``made`` trips exist; ``started`` (plan_id, started) counts the trips of each plan that started up to ``as_of``. Crews
    are assigned to new trips and to ``crew_trips``: trips that changed, or whose plan's crews or whose crews did, since the last run.
    """

    as_of: dt.datetime
    made: int
    started: DataFrame
    crew_trips: DataFrame


def started_trips_of_plans(trips: DataFrame, now: dt.datetime, after: dt.datetime | None = None) -> DataFrame:
    """(plan_id, started): trips of each plan that started by ``now``, of those that started after ``after`` if it is given."""
    start = F.col("start_trip")
    rows = trips.where(start <= timestamp_lit(now))
    if after is not None:
        # A trip ends after it starts, so trips stored under earlier days did not start later.
        rows = since(rows, after).where(start > timestamp_lit(after))
    return rows.groupBy("plan_id").agg(F.count(F.lit(1)).alias("started"))


def counts_forward(kept: Kept, trips: DataFrame, now: dt.datetime) -> DataFrame:
    """Counts of the plans with trips that started since the kept counts were taken, brought up to ``now``."""
    new = started_trips_of_plans(trips, now, kept.as_of)
    before = kept.started.join(new.select("plan_id"), "plan_id", "left_semi").select("plan_id", "started")
    return new.unionByName(before).groupBy("plan_id").agg(F.sum("started").alias("started"))


def build_trips(to_create: DataFrame, due: DataFrame, fleet, now: dt.datetime, made: int | None = None) -> DataFrame:
    """New trips: end on the next day if the plan ends before it starts, main driver and vehicle, running number.

    ``made`` is the number of trips there are; without it they are counted."""
    plans = due.select(F.col("id").alias("plan_id"), "start_date", "end_date")

    def main(table: DataFrame, column: str) -> DataFrame:
        return table.where(F.col("is_main") & ~F.col("is_deleted")).select("plan_id", column)

    overnight = seconds_of_day(F.col("end_date")) < seconds_of_day(F.col("start_date"))
    end_day = F.date_add(F.col("start_trip").cast("date"), F.when(overnight, 1).otherwise(0))
    rows = (
        to_create.join(plans, "plan_id")
        .join(main(fleet.driver_plans, "driver_id"), "plan_id", "left")
        .join(main(fleet.vehicle_plans, "vehicle_id"), "plan_id", "left")
        .select("plan_id", "start_trip", on_day(end_day, F.col("end_date")).alias("end_trip"), "driver_id", "vehicle_id")
    )
    numbered = consecutive_numbers(
        rows, ["plan_id", "start_trip", "driver_id", "vehicle_id"], "number", start=(fleet.trips.count() if made is None else made) + 1
    )
    month = F.concat(F.year("start_trip").cast("string"), F.month("start_trip").cast("string"))
    return numbered.select(
        derived_key(fleet.trips.schema["id"].dataType, "plan_id", "start_trip", "number").alias("id"),
        "plan_id", "start_trip", "end_trip", "driver_id", "vehicle_id",
        F.col("start_trip").cast("date").alias("trip_date"),
        F.concat_ws("-", F.lit(REFERENCE_PREFIX), month, F.col("number").cast("string")).alias("reference_code"),
        F.lit(TRIP_PLANNED).alias("status"),
        F.lit(False).alias("is_deleted"),
        timestamp_lit(now).alias("created_date"),
    )


def _of_trips(due: DataFrame, trips: DataFrame, *columns: str) -> DataFrame:
    """Due plans with their new trips: trip columns under trip_id, start_trip, trip_date."""
    new = trips.select(F.col("id").alias("trip_id"), "plan_id", "start_trip", "trip_date")
    return due.select(F.col("id").alias("plan_id"), "plan_copy", *columns).join(new, "plan_id")


def trip_summaries(due: DataFrame, trips: DataFrame, key_type) -> DataFrame:
    zero = F.lit(0.0)
    return _of_trips(due, trips, "expected_coverage").select(
        derived_key(key_type, F.lit("summary"), "trip_id", "plan_copy").alias("id"),
        "trip_id",
        "expected_coverage",
        zero.alias("actual_coverage"),
        zero.alias("completion_pct"),
        F.lit(None).cast("timestamp_ntz").alias("actual_start"),
        zero.alias("waste_weight"),
        F.lit(NEW_SUMMARY_STATUS).alias("status"),
        F.lit(NEW_DISCHARGE_STATUS).alias("discharge_status"),
    )


def trip_texts(due: DataFrame, trips: DataFrame, fleet) -> DataFrame:
    """Per language: plan text, weekday name, start with a 12-hour clock."""
    text = F.concat_ws(
        " - ", F.coalesce("description", F.lit("")), "name", F.date_format("start_trip", TEXT_TIME_FORMAT)
    )
    return (
        _of_trips(due, trips)
        .join(fleet.plan_texts, "plan_id")
        .withColumn("day", weekday_index(F.col("trip_date")))
        .join(fleet.weekdays.select("day", "name"), "day")
        .select("trip_id", "locale", text.alias("description"))
    )


def trip_stops(due: DataFrame, trips: DataFrame, fleet, key_type) -> DataFrame:
    """Stops of new trips: the plan's details, length times repetitions a day, hash of the tag."""
    repetitions = F.when(F.col("repetitions") > 0, F.col("repetitions")).otherwise(1)
    length = F.when(F.col("length") > 0, F.col("length") * repetitions).otherwise(0.0)
    copy = F.row_number().over(Window.partitionBy("service_id").orderBy("repetitions"))
    contract_rows = fleet.contract_details.select("service_id", "repetitions").withColumn("contract_copy", copy)
    geometry = fleet.streets.select(F.col("id").alias("geometry_id"), F.col("reference_code"))
    return (
        _of_trips(due, trips, "service_id")
        .join(fleet.plan_details.withColumnRenamed("id", "detail_id"), "plan_id")
        .join(contract_rows, "service_id")
        .join(geometry.withColumn("found_id", F.col("geometry_id")), "geometry_id", "left")
        .select(
            derived_key(key_type, "trip_id", "detail_id", "plan_copy", "contract_copy").alias("id"),
            "trip_id", "tag", "bin_id", "stop_order", "street_weight",
            length.alias("street_length"),
            F.col("found_id").alias("geometry_id"),
            "reference_code",
            tag_hash(F.col("tag")).alias("tag_hash"),
            F.lit(False).alias("is_deleted"),
        )
    )


def stop_summaries(due: DataFrame, trips: DataFrame, stops: DataFrame, fleet, key_type) -> DataFrame:
    """Open summary of each new stop at its bin's position, or at 0."""
    zero = F.lit(0.0)
    bins = fleet.bins.select(
        F.col("id").alias("bin_id"), F.col("longitude").alias("bin_lon"), F.col("latitude").alias("bin_lat")
    )
    return (
        _of_trips(due, trips)
        .select("trip_id", "plan_copy")
        .join(stops.select("trip_id", F.col("id").alias("stop_id"), "bin_id"), "trip_id")
        .join(bins, "bin_id", "left")
        .select(
            derived_key(key_type, F.lit("summary"), "stop_id", "plan_copy").alias("id"),
            "stop_id",
            F.coalesce("bin_lon", zero).alias("bin_longitude"),
            F.coalesce("bin_lat", zero).alias("bin_latitude"),
            F.lit(NEW_BIN_STATUS).alias("bin_status"),
            F.lit(None).cast("int").alias("status_lookup"),
            F.lit(NEW_COMPLETION_TYPE).alias("completion_type"),
            F.lit(0).alias("lifts"),
            *(zero.alias(c) for c in ("completion_pct", "total_distance", "brush_distance", "water_distance", "gps_distance")),
            F.lit(False).alias("is_swept"),
        )
    )


def duplicate_tags(stops: DataFrame) -> DataFrame:
    """Stops that repeat a tag within a trip, with their place (from 2) by stop id."""
    tagged = stops.where(F.col("tag").isNotNull()).select(
        "trip_id", F.col("id").alias("stop_id"), tag_key(F.col("tag")).alias("tag_key")
    )
    return consecutive_numbers(tagged, ["stop_id"], "place", keys=["tag_key", "trip_id"]).where("place > 1")


def new_trips_report(to_create: DataFrame, plans: DataFrame, monthly: bool) -> DataFrame:
    """Starts of weekly or of monthly plans, by creation of the plan."""
    columns = plans.where(F.col("is_monthly") == monthly).select(
        F.col("id").alias("plan_id"), "service_id", "contract_id", "created_date"
    )
    return to_create.join(columns, "plan_id").orderBy("created_date", "plan_id", "start_trip")


def active_trips(plans: DataFrame, starts: DataFrame, trips: DataFrame, now: dt.datetime, kept: Kept | None = None) -> DataFrame:
    """Plans with a start take the number of their trips that have started; the others keep theirs."""
    if kept is None:
        counts = started_trips_of_plans(trips, now)
    else:
        forward = counts_forward(kept, trips, now)
        counts = kept.started.select("plan_id", "started").join(forward, "plan_id", "left_anti").unionByName(forward)
    started = counts.select(F.col("plan_id").alias("id"), F.col("started").cast("int").alias("_started"))
    planned = starts.select(F.col("plan_id").alias("id")).distinct().withColumn("_planned", F.lit(True))
    value = F.when(F.col("_planned"), F.coalesce("_started", F.lit(0))).otherwise(F.col("active_trips"))
    return (
        plans.join(planned, "id", "left").join(started, "id", "left").withColumn("active_trips", value)
        .drop("_planned", "_started")
    )


def advance_status(trips: DataFrame, now: dt.datetime) -> DataFrame:
    """Planned trips count as started from one hour before their start."""
    due = (F.col("status") == TRIP_PLANNED) & (F.col("start_trip") <= timestamp_lit(now + STARTS_BEFORE))
    return trips.withColumn("status", F.when(due, F.lit(TRIP_STARTED)).otherwise(F.col("status")))


def crew_assignments(trips: DataFrame, crew_plans: DataFrame, crew_trips: DataFrame) -> DataFrame:
    """Crews of live trips that are not assigned to the trip yet."""
    assigned = crew_trips.where(~F.col("is_deleted")).select("trip_id", "crew_id")
    return (
        trips.where(~F.col("is_deleted"))
        .select(F.col("id").alias("trip_id"), "plan_id")
        .join(crew_plans.select("plan_id", "crew_id"), "plan_id")
        .select("trip_id", "crew_id")
        .join(assigned, ["trip_id", "crew_id"], "left_anti")
    )


class TripRun:
    """All frames of one run for ``today``; the shared ones are settled."""

    def __init__(self, fleet, today: dt.date, now: dt.datetime, kept: Kept | None = None):
        self.fleet, self.today, self.now, self.kept = fleet, today, now, kept

    @cached_property
    def due(self) -> DataFrame:
        return cut_lineage(plans_due(self.fleet, self.today))

    @cached_property
    def weekly(self) -> DataFrame:
        return weekly_starts(self.due, self.fleet, self.today, self.now)

    @cached_property
    def monthly(self) -> DataFrame:
        return monthly_starts(self.due, self.today)

    @cached_property
    def starts(self) -> DataFrame:
        return cut_lineage(self.weekly.unionByName(self.monthly))

    @cached_property
    def to_create(self) -> DataFrame:
        return trips_to_create(self.starts, existing_trips(self.starts, self.fleet.trips))

    @cached_property
    def trips(self) -> DataFrame:
        made = None if self.kept is None else self.kept.made
        return cut_lineage(build_trips(self.to_create, self.due, self.fleet, self.now, made))

    @cached_property
    def summaries(self) -> DataFrame:
        return trip_summaries(self.due, self.trips, self.fleet.trip_summaries.schema["id"].dataType)

    @cached_property
    def texts(self) -> DataFrame:
        return trip_texts(self.due, self.trips, self.fleet)

    @cached_property
    def stops(self) -> DataFrame:
        return cut_lineage(trip_stops(self.due, self.trips, self.fleet, self.fleet.stops.schema["id"].dataType))

    @cached_property
    def stop_summaries(self) -> DataFrame:
        key_type = self.fleet.stop_summaries.schema["id"].dataType
        return stop_summaries(self.due, self.trips, self.stops, self.fleet, key_type)

    @cached_property
    def all_trips(self) -> DataFrame:
        """Stored and new trips, with planned ones advanced."""
        both = self.fleet.trips.unionByName(self.trips, allowMissingColumns=True)
        return advance_status(both, self.now)

    @cached_property
    def plans(self) -> DataFrame:
        return active_trips(self.fleet.plans, self.starts, self.all_trips, self.now, self.kept)

    @cached_property
    def crews(self) -> DataFrame:
        if self.kept is None:
            return crew_assignments(self.all_trips, self.fleet.crew_plans, self.fleet.crew_trips)
        columns = ["id", "plan_id", "is_deleted"]
        trips = self.kept.crew_trips.select(*columns).unionByName(self.trips.select(*columns)).dropDuplicates(["id"])
        return crew_assignments(trips, self.fleet.crew_plans, self.fleet.crew_trips)
