"""Street sweeping: pings to streets, driven metres, street and trip completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbflow.functions.geo import haversine_metres
from curbflow.functions.numeric import at_most_hundred, ratio
from curbflow.functions.time import time_slice
from curbflow.operators import covering, near_lines, previous_row
from curbflow.operators.nearby import cells_of_line, line_cells
from curbflow.plans.sweep_rules import CURRENT, SweepRules
from curbflow.session import cut_lineage

# Degrees from a street that still count as on it, geometry and trip codes.
STREET_TOLERANCE_DEGREES = 0.0002
STREET_GEOMETRY = 2
RUNNING_TRIP = 3

# A trip is matched to pings through the slices of time it touches.
TRIP_SLICE_SECONDS = 4 * 3600

# What tells one street of one trip apart; a plan may be driven by vehicles of several types.
STREET_KEYS = (
    "trip_id", "stop_summary_id", "vehicle_type", "company_type",
    "stop_order", "street_length", "street_weight", "total_distance",
)


def running_trips(fleet, active: DataFrame) -> DataFrame:
    """Running trips of vehicles that were out in them: one row per trip, vehicle and trip summary.

    ``active`` has the (vehicle_id, out_at) pairs with pings, out_at the start of a slice of time.
    """
    plans = (
        fleet.plans.select(F.col("id").alias("plan_id"), "service_id", F.col("contract_id").alias("contract_id"),
                           "active_trips", F.col("completion_pct").alias("plan_old_pct"))
        .join(
            fleet.services.select(
                F.col("id").alias("service_id"), "group_id", "group_type",
                F.col("contract_id").alias("service_contract_id"),
            ),
            "service_id",
        )
        .join(
            fleet.contracts.select(F.col("id").alias("service_contract_id"), "contract_type_id"),
            "service_contract_id",
        )
        .join(fleet.contract_types.select(F.col("id").alias("contract_type_id")), "contract_type_id")
        .drop("service_contract_id")
    )
    vehicles = (
        fleet.vehicles.select(F.col("id").alias("vehicle_id"), "vehicle_type_id", "company_id")
        .join(
            fleet.vehicle_types.select(F.col("id").alias("vehicle_type_id"), F.col("type").alias("vehicle_type")),
            "vehicle_type_id",
        )
        .join(fleet.companies.select(F.col("id").alias("company_id"), F.col("type").alias("company_type")), "company_id")
        .drop("vehicle_type_id")
    )
    windows = (
        fleet.trips.where(~F.col("is_deleted") & (F.col("status") == RUNNING_TRIP))
        .select(F.col("id").alias("trip_id"), "plan_id", "start_trip", "end_trip")
        .where("start_trip < end_trip")
        .join(fleet.vehicle_plans.select("plan_id", "vehicle_id"), "plan_id")
    )
    # A slice that a trip touches lies in the trip's slices, both ends included.
    from_ = slice_start(F.col("start_trip"))
    touched = windows.withColumn("first_slice", from_).select("trip_id", "vehicle_id", "first_slice", "end_trip")
    out = covering(active, touched, "vehicle_id", "out_at", "first_slice", "end_trip", TRIP_SLICE_SECONDS, closed_end=True)
    return (
        windows.join(out.select("trip_id", "vehicle_id").distinct(), ["trip_id", "vehicle_id"], "left_semi")
        .join(vehicles, "vehicle_id")
        .join(plans, "plan_id")
        .join(fleet.trip_summaries.select("trip_id", F.col("id").alias("trip_summary_id")), "trip_id")
    )


def slice_start(moment: Column) -> Column:
    """The start of the slice of time that holds a moment."""
    seconds = time_slice(moment, TRIP_SLICE_SECONDS) * TRIP_SLICE_SECONDS
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def streets_of_trips(fleet, trips: DataFrame, tolerance: float = STREET_TOLERANCE_DEGREES) -> DataFrame:
    """Streets of the given trips, one row per stop summary and grid cell.

    Only streets that these trips sweep are put on the grid. Cells stored with the streets are taken as they are.
    """
    stops = (
        fleet.stops.where(F.col("geometry_id").isNotNull())
        .join(trips.select("trip_id").distinct(), "trip_id", "left_semi")
        .select("trip_id", F.col("id").alias("stop_id"), "geometry_id", "stop_order", "street_length", "street_weight")
        .join(
            fleet.stop_summaries.select(F.col("id").alias("stop_summary_id"), "stop_id", "total_distance"), "stop_id"
        )
        .drop("stop_id")
    )
    stops = cut_lineage(stops)
    lines = fleet.streets.where(F.col("geo_type") == STREET_GEOMETRY).withColumnRenamed("id", "geometry_id")
    lines = lines.join(stops.select("geometry_id").distinct(), "geometry_id", "left_semi")
    stored = "cells" if "cells" in lines.columns and tolerance == STREET_TOLERANCE_DEGREES else None
    return stops.join(line_cells(lines, "geometry_id", "line", tolerance, stored), "geometry_id").drop("geometry_id")


def with_cells(streets: DataFrame) -> DataFrame:
    """Streets with their grid cells beside them; to be stored whenever a street is added or changed."""
    cells = F.when(F.col("geo_type") == STREET_GEOMETRY, cells_of_line(F.col("line"), STREET_TOLERANCE_DEGREES))
    return streets.withColumn("cells", cells)


def street_proximity(pings: DataFrame, fleet, tolerance: float = STREET_TOLERANCE_DEGREES) -> DataFrame:
    """Untagged pings on a street of a trip their vehicle's plan runs at that moment, [start, end).

    Pings meet the windows of running trips first, which are few beside them, and then the streets of their trip in one
    join on (trip, cell); a busy trip spreads over its cells. Besides, two columns of the pings are read to learn which
    vehicles were out when.
    """
    placed = pings.select(
        F.col("id").alias("ping_id"), "vehicle_id", "movement_time", "longitude", "latitude",
        "input1", "input2", "input3", "input4", "speed", "ignition",
    )
    active = placed.select("vehicle_id", slice_start(F.col("movement_time")).alias("out_at")).distinct()
    trips = cut_lineage(running_trips(fleet, active))
    in_trip = covering(placed, trips, "vehicle_id", "movement_time", "start_trip", "end_trip", TRIP_SLICE_SECONDS)
    streets = streets_of_trips(fleet, trips, tolerance)
    near = near_lines(in_trip, streets, ["trip_id"], "longitude", "latitude", tolerance)
    return near.drop("start_trip", "end_trip")


def ping_segments(locations: DataFrame) -> DataFrame:
    """Add the position of the vehicle's ping before: last_longitude, last_latitude (null on its first).

    The ping before may lie on another street or trip. Pings at the same moment
    are taken by street order, then stop summary, ping and trip summary, so the order is total.
    """
    order = ["stop_order", "stop_summary_id", "ping_id", "trip_summary_id"]
    segments = previous_row(locations, "vehicle_id", "movement_time", order, ["longitude", "latitude"])
    return segments.withColumns(
        {"last_longitude": F.col("previous.longitude"), "last_latitude": F.col("previous.latitude")}
    ).drop("previous")


def segment_metres(segments: DataFrame) -> DataFrame:
    """Add ``metres`` driven since the ping before; null on a vehicle's first ping."""
    return segments.withColumn(
        "metres",
        haversine_metres(F.col("latitude"), F.col("longitude"), F.col("last_latitude"), F.col("last_longitude")),
    )


def validity_flags(df: DataFrame, rules: SweepRules = CURRENT) -> DataFrame:
    """Add gps_on, water_on, brush_on, side_on, valid."""
    return df.withColumns(rules.flags())


def street_totals(measured: DataFrame) -> DataFrame:
    """Metres per street: valid, water, brush, gps; also its segments, first ping and least company id.

    Input has the flags and ``metres``, which is null on a vehicle's first ping.
    """

    def metres_if(flag: str):
        return F.sum(F.when(F.col(flag), F.coalesce("metres", F.lit(0.0))).otherwise(0.0))

    return measured.groupBy(*STREET_KEYS).agg(
        metres_if("valid").alias("valid_metres"),
        metres_if("water_on").alias("water_metres"),
        metres_if("brush_on").alias("brush_metres"),
        metres_if("gps_on").alias("gps_metres"),
        F.count("metres").alias("segments"),
        F.min("movement_time").alias("first_ping"),
        F.min("company_id").alias("company_id"),
    )


def street_distances(totals: DataFrame) -> DataFrame:
    """Totals of the streets with at least one segment."""
    return totals.where("segments > 0")


def street_completion(streets: DataFrame) -> DataFrame:
    """Add ``completion``: 100 if this batch alone passes the length, else all metres over the length.

    May exceed 100 here; the state update caps it.
    """
    share = ratio(F.col("total_distance") + F.col("valid_metres"), F.col("street_length")) * 100
    return streets.withColumn(
        "completion",
        F.when(F.col("valid_metres") > F.col("street_length"), 100.0).otherwise(F.coalesce(share, F.lit(0.0))),
    )


# A vehicle's last position, as one batch leaves it for the next.
LAST_POSITION = "vehicle_id bigint, movement_time timestamp_ntz, longitude double, latitude double"


def driven_streets(locations: DataFrame, rules: SweepRules = CURRENT, before: DataFrame | None = None) -> DataFrame:
    """Locations to street totals. All later sweeping steps start from this frame, not from the pings.

    The flags look at one ping only, so they are set before the shuffle of the
    lag and the raw inputs do not travel. ``before`` has the last position of each vehicle in earlier batches; without
    it a vehicle's first ping has no segment.
    """
    columns = ("ping_id", "trip_summary_id", "vehicle_id", "company_id", "movement_time", "longitude", "latitude", *STREET_KEYS)
    flagged = validity_flags(locations, rules).select(*columns, "gps_on", "water_on", "brush_on", "valid")
    if before is None:
        return street_totals(segment_metres(ping_segments(flagged)))
    out = before.join(flagged.select("vehicle_id").distinct(), "vehicle_id", "left_semi")
    carried = flagged.withColumn("carried", F.lit(False)).unionByName(out.withColumn("carried", F.lit(True)), allowMissingColumns=True)
    return street_totals(segment_metres(ping_segments(carried)).where("not carried").drop("carried"))


def last_positions(locations: DataFrame, before: DataFrame) -> DataFrame:
    """The latest position of each vehicle with locations, in the order that segments are taken in."""
    order = ["movement_time", "stop_order", "stop_summary_id", "ping_id", "trip_summary_id"]
    last = F.max(F.struct(*order, "longitude", "latitude")).alias("last")
    new = locations.groupBy("vehicle_id").agg(last).select("vehicle_id", "last.movement_time", "last.longitude", "last.latitude")
    known = before.join(new.select("vehicle_id"), "vehicle_id", "left_semi").select(*new.columns)
    # The new one wins where both are of one moment.
    both = new.withColumn("new", F.lit(1)).unionByName(known.withColumn("new", F.lit(0)))
    last = F.max(F.struct("movement_time", "new", "longitude", "latitude")).alias("last")
    return both.groupBy("vehicle_id").agg(last).select("vehicle_id", "last.movement_time", "last.longitude", "last.latitude")


def swept_streets(locations: DataFrame, rules: SweepRules = CURRENT) -> DataFrame:
    """Locations to street completion, the whole chain."""
    return street_completion(street_distances(driven_streets(locations, rules)))


def street_state(stop_summaries: DataFrame, streets: DataFrame) -> DataFrame:
    """Stop summaries after the sweep: distance adds up, the rest is replaced unless the new value is 0.

    A stop driven by two vehicle types has two street rows; the greater (type, company) wins.
    """
    found = F.struct("vehicle_type", "company_type", "valid_metres", "completion",
                     "brush_metres", "water_metres", "gps_metres")
    latest = streets.groupBy(F.col("stop_summary_id").alias("id")).agg(F.max(found).alias("s"))
    touched = F.col("s").isNotNull()

    def renewed(new: str, old: str):
        return F.coalesce(F.nullif(F.col(f"s.{new}"), F.lit(0.0)), F.col(old))

    return (
        stop_summaries.join(latest, "id", "left")
        .withColumns(
            {
                "is_swept": F.when(touched, F.lit(True)).otherwise(F.col("is_swept")),
                "total_distance": F.when(
                    touched, F.col("total_distance") + F.coalesce("s.valid_metres", F.lit(0.0))
                ).otherwise(F.col("total_distance")),
                "completion_pct": F.when(
                    touched, at_most_hundred(renewed("completion", "completion_pct"))
                ).otherwise(F.col("completion_pct")),
                "brush_distance": renewed("brush_metres", "brush_distance"),
                "water_distance": renewed("water_metres", "water_distance"),
                "gps_distance": renewed("gps_metres", "gps_distance"),
            }
        )
        .drop("s")
    )


def swept_trips(streets: DataFrame, stop_summaries: DataFrame, fleet) -> DataFrame:
    """Weighted completion of each touched trip over all its stops, with its plan and contract columns.

    ``stop_summaries`` is the state after :func:`street_state`.
    """
    touched = streets.groupBy("trip_id").agg(F.sum("valid_metres").alias("valid_metres"))
    per_trip = (
        fleet.stops.select(F.col("id").alias("stop_id"), "trip_id", "street_weight")
        .join(touched.select("trip_id"), "trip_id", "left_semi")
        .join(stop_summaries.select("stop_id", "completion_pct"), "stop_id")
        .groupBy("trip_id")
        .agg(
            F.sum("street_weight").alias("weight"),
            F.sum(F.col("completion_pct") * F.col("street_weight")).alias("weighted"),
        )
    )
    completion = F.when(F.col("weight") == 0, 0.0).otherwise(ratio(F.col("weighted"), F.col("weight")))
    return (
        touched.join(per_trip, "trip_id")
        .join(fleet.trips.select(F.col("id").alias("trip_id"), "plan_id"), "trip_id")
        .join(fleet.trip_summaries.select("trip_id", F.col("id").alias("trip_summary_id")), "trip_id")
        .join(plan_context(fleet), "plan_id")
        .withColumn("trip_pct", completion)
        .drop("weight", "weighted")
    )


def plan_context(fleet) -> DataFrame:
    """Plan columns that the roll-up carries: service, contract, group, old average."""
    return fleet.plans.select(
        F.col("id").alias("plan_id"), "service_id", "contract_id", "active_trips",
        F.col("completion_pct").alias("plan_old_pct"),
    ).join(fleet.services.select(F.col("id").alias("service_id"), "group_id"), "service_id")


def seen_plans(totals: DataFrame, fleet) -> DataFrame:
    """Plans with a ping on one of their streets: plan, service, contract, group, company ids, group and contract type."""
    trips = totals.groupBy("trip_id").agg(F.min("company_id").alias("company_id"))
    types = (
        fleet.services.select(F.col("id").alias("service_id"), "group_type", F.col("contract_id").alias("owner_id"))
        .join(fleet.contracts.select(F.col("id").alias("owner_id"), "contract_type_id"), "owner_id").drop("owner_id")
    )
    plans = trips.join(fleet.trips.select(F.col("id").alias("trip_id"), "plan_id"), "trip_id").join(plan_context(fleet), "plan_id")
    return plans.join(types, "service_id")


def sweep_trip_state(trip_summaries: DataFrame, trips: DataFrame, totals: DataFrame) -> DataFrame:
    """Trip summaries after the sweep. ``trips`` is :func:`swept_trips`; coverage grows by the metres.

    The first ping counts for the start of the trip even where it has no segment.
    """
    first = totals.groupBy("trip_id").agg(F.min("first_ping").alias("first_ping"))
    new = (
        trips.select(F.col("trip_summary_id").alias("id"), "trip_id", "trip_pct", "valid_metres")
        .join(first, "trip_id")
        .drop("trip_id")
    )
    touched = F.col("valid_metres").isNotNull()
    return (
        trip_summaries.join(new, "id", "left")
        .withColumns(
            {
                "completion_pct": F.when(touched, F.col("trip_pct")).otherwise(F.col("completion_pct")),
                "actual_start": F.coalesce("actual_start", "first_ping"),
                "actual_coverage": F.col("actual_coverage") + F.coalesce("valid_metres", F.lit(0.0)),
            }
        )
        .drop("trip_pct", "valid_metres", "first_ping")
    )
