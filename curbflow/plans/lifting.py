"""What matched tag reads change: bins, stops, stop summaries, trips, waste, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from curbflow.functions.geo import haversine_metres
from curbflow.functions.keys import derived_key
from curbflow.functions.numeric import at_most_hundred, percent_2dp, ratio
from curbflow.functions.text import tag_key
from curbflow.functions.time import minutes_between, timestamp_lit
from curbflow.operators import first_per

# Bin states, stop states by case, relift gap, alert distance.
BIN_OPEN = 1
BIN_LIFTED = 2
STATUS_OF_CASE = {1: 13, 2: 14, 3: 15, 4: 16, 5: 17, 6: 18}
RELIFT_MINUTES = 60
MAX_METRES_FROM_REFERENCE = 5
NEW_STOP_ORDER = -1
NEW_STOP_REFERENCE = "TRD-00000-00000"
SAME_SCOPE, OTHER_SCOPE = 1, 2
STARTED_TRIP_SUMMARY = 2


def _in_case(matches: DataFrame, *cases: int) -> DataFrame:
    return matches.where(F.col("case_no").isin(*cases))


# ---- places ------------------------------------------------------------------


def _place_of_tag(matches: DataFrame) -> DataFrame:
    """tag_key, case_no, new position. A tag has one read, so the rows of a tag agree."""
    return matches.groupBy("tag_key").agg(
        F.min("case_no").alias("case_no"),
        F.min("longitude").alias("new_longitude"),
        F.min("latitude").alias("new_latitude"),
    )


def _modified(changed: Column, now: dt.datetime | None) -> Column:
    """Date of the change; without a clock the old date stays."""
    old = F.col("modified_date")
    return old if now is None else F.when(changed, timestamp_lit(now)).otherwise(old)


def bin_location_update(
    bins: DataFrame, matches: DataFrame, include_case_6: bool = False, now: dt.datetime | None = None
) -> DataFrame:
    """Bins with the position of their tag's read and the label of its case.

    By default a bin matched by case 6 alone stays where it is, as in the
    procedure this follows; ``include_case_6`` moves it too.
    """
    cases = (1, 2, 3, 4, 5, 6, 7) if include_case_6 else (1, 2, 3, 4, 5, 7)
    moved = F.col("case_no").isNotNull() & ~F.col("is_deleted")
    return (
        bins.withColumn("tag_key", tag_key(F.col("tag")))
        .join(_place_of_tag(_in_case(matches, *cases)), "tag_key", "left")
        .withColumns(
            {
                "longitude": F.when(moved, F.col("new_longitude")).otherwise(F.col("longitude")),
                "latitude": F.when(moved, F.col("new_latitude")).otherwise(F.col("latitude")),
                "modified_by": F.when(moved, F.concat(F.lit("lift_case_"), F.col("case_no").cast("string"))).otherwise(
                    F.col("modified_by")
                ),
                "modified_date": _modified(moved, now),
            }
        )
        .drop("tag_key", "case_no", "new_longitude", "new_latitude")
    )


def geometry_location_update(streets: DataFrame, matches: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Geometry rows of tags lifted on plan (case 1) take the position of the read."""
    moved = F.col("new_longitude").isNotNull() & ~F.col("is_deleted")
    return (
        streets.withColumn("tag_key", tag_key(F.col("tag")))
        .join(_place_of_tag(_in_case(matches, 1)).drop("case_no"), "tag_key", "left")
        .withColumns(
            {
                "longitude": F.when(moved, F.col("new_longitude")).otherwise(F.col("longitude")),
                "latitude": F.when(moved, F.col("new_latitude")).otherwise(F.col("latitude")),
                "modified_by": F.when(moved, F.lit("lift_case_1")).otherwise(F.col("modified_by")),
                "modified_date": _modified(moved, now),
            }
        )
        .drop("tag_key", "new_longitude", "new_latitude")
    )


def _latest_per_tag(rows: DataFrame, tags: DataFrame, *kept: str) -> DataFrame:
    """Latest row of each wanted tag: by modified, then created date, then least id."""
    wanted = rows.withColumn("tag_key", tag_key(F.col("tag"))).join(tags.select("tag_key"), "tag_key", "left_semi")
    order = [F.col("modified_date").desc_nulls_last(), F.col("created_date").desc_nulls_last(), F.col("id")]
    return first_per(wanted, ["tag_key"], order).select("tag_key", *kept)


def top_bin_per_tag(bins: DataFrame, tags: DataFrame) -> DataFrame:
    return _latest_per_tag(
        bins, tags, "id", "longitude", "latitude"
    ).withColumnsRenamed({"id": "bin_id", "longitude": "bin_longitude", "latitude": "bin_latitude"})


def top_geometry_per_tag(streets: DataFrame, tags: DataFrame) -> DataFrame:
    return _latest_per_tag(streets, tags, "id").withColumnRenamed("id", "geometry_id")


# ---- stop summaries ----------------------------------------------------------


def lift_state(stop_summaries: DataFrame, lifted: DataFrame, case_no: int, eligible: Column) -> DataFrame:
    """Stop summaries after the reads of one case.

    ``lifted`` has summary_id and the read's columns. An open bin becomes
    lifted; a lifted one counts again after an hour, by minute boundaries. If
    several reads name one summary the earliest counts, then the least ping id.
    """
    read = F.struct("movement_time", "ping_id", "vehicle_id", "longitude", "latitude", "imei")
    new = lifted.groupBy(F.col("summary_id").alias("id")).agg(F.min(read).alias("read"))
    hit = F.col("read").isNotNull() & F.coalesce(eligible, F.lit(False))
    opened = hit & (F.col("bin_status") == BIN_OPEN)
    relift = (
        hit
        & (F.col("bin_status") == BIN_LIFTED)
        & (minutes_between(F.col("last_completion"), F.col("read.movement_time")) >= RELIFT_MINUTES)
    )
    moment = F.col("read.movement_time")

    def after(change: Column, value: Column, name: str) -> Column:
        return F.when(change, value).otherwise(F.col(name))

    return (
        stop_summaries.join(new, "id", "left")
        .withColumns(
            {
                "bin_status": after(opened, F.lit(BIN_LIFTED), "bin_status"),
                "completion_time": after(opened, moment, "completion_time"),
                "last_completion": after(opened | F.coalesce(relift, F.lit(False)), moment, "last_completion"),
                "lifts": F.when(opened, F.lit(1)).when(relift, F.col("lifts") + 1).otherwise(F.col("lifts")),
                "status_lookup": after(hit, F.lit(STATUS_OF_CASE[case_no]), "status_lookup"),
                "bin_longitude": after(hit, F.col("read.longitude"), "bin_longitude"),
                "bin_latitude": after(hit, F.col("read.latitude"), "bin_latitude"),
                "vehicle_id": after(hit, F.col("read.vehicle_id"), "vehicle_id"),
                "device": after(hit, F.col("read.imei").try_cast("bigint"), "device"),
            }
        )
        .drop("read")
    )


def lift_state_case1(stop_summaries: DataFrame, matches: DataFrame, strict_nulls: bool = True) -> DataFrame:
    """On-plan lifts. ``strict_nulls``: a stop without a status is left alone (the procedure
    compares with ``= null``); False gives the evident intent, no status or 13."""
    status = F.col("status_lookup")
    eligible = status == STATUS_OF_CASE[1] if strict_nulls else status.isNull() | (status == STATUS_OF_CASE[1])
    return lift_state(stop_summaries, _in_case(matches, 1), 1, eligible)


def lift_state_case2(stop_summaries: DataFrame, matches: DataFrame) -> DataFrame:
    """Late on-plan lifts: stops without a status or with 14."""
    status = F.col("status_lookup")
    return lift_state(stop_summaries, _in_case(matches, 2), 2, status.isNull() | (status == STATUS_OF_CASE[2]))


def lift_state_other_vehicle(stop_summaries: DataFrame, matches: DataFrame, case_no: int) -> DataFrame:
    """Cases 5 and 6, intended form: the stop of the chosen trip, if it has no status yet.

    In the procedure this follows the stop is never filled in for these cases,
    so nothing changes; a batch runs it only on request.
    """
    summary_of_stop = stop_summaries.select("stop_id", F.col("id").alias("summary_id"))
    lifted = _in_case(matches, case_no).drop("summary_id").join(summary_of_stop, "stop_id")
    return lift_state(stop_summaries, lifted, case_no, F.col("status_lookup").isNull())


def off_plan_stops(
    matches: DataFrame, bins: DataFrame, streets: DataFrame, stops: DataFrame, trips: DataFrame
) -> DataFrame:
    """New stops for cases 3 and 4: one per trip and tag that has a bin and is not a live stop yet.

    Beside the stop's columns: imei, vehicle_id and the bin's position, for its summary.
    """
    found = (
        _in_case(matches, 3, 4)
        .groupBy("trip_id", "tag_key", "case_no")
        .agg(
            F.min("movement_time").alias("created_date"),
            F.max("imei").alias("imei"),
            F.max("vehicle_id").alias("vehicle_id"),
            F.min("tag").alias("tag"),
        )
    )
    live = (
        stops.where(F.col("tag").isNotNull() & ~F.col("is_deleted"))
        .select("trip_id", tag_key(F.col("tag")).alias("tag_key"))
        .join(trips.where(~F.col("is_deleted")).select(F.col("id").alias("trip_id")), "trip_id", "left_semi")
    )
    key_type = stops.schema["id"].dataType
    return (
        found.join(live, ["trip_id", "tag_key"], "left_anti")
        .join(top_bin_per_tag(bins, found), "tag_key")
        .join(top_geometry_per_tag(streets, found), "tag_key", "left")
        .select(
            derived_key(key_type, "trip_id", "tag_key").alias("id"),
            "case_no", "trip_id", "tag", "tag_key", "bin_id", "geometry_id", "created_date", "imei", "vehicle_id",
            "bin_longitude", "bin_latitude",
            F.lit(NEW_STOP_ORDER).alias("stop_order"),
            F.lit(0.0).alias("street_weight"),
            F.lit(0.0).alias("street_length"),
            F.lit(NEW_STOP_REFERENCE).alias("reference_code"),
            F.lit(False).alias("is_deleted"),
        )
    )


def off_plan_summaries(new_stops: DataFrame, key_type=None) -> DataFrame:
    """Summary of each new stop: lifted once, status 15 (case 3) or 16 (case 4)."""
    zero = F.lit(0.0)
    return new_stops.select(
        derived_key(key_type or StringType(), F.lit("summary"), "trip_id", "tag_key").alias("id"),
        F.col("id").alias("stop_id"),
        F.lit(BIN_LIFTED).alias("bin_status"),
        F.when(F.col("case_no") == 3, STATUS_OF_CASE[3]).otherwise(STATUS_OF_CASE[4]).alias("status_lookup"),
        F.col("created_date").alias("last_completion"),
        F.col("created_date").alias("completion_time"),
        F.lit(1).alias("lifts"),
        zero.alias("completion_pct"),
        zero.alias("total_distance"),
        zero.alias("brush_distance"),
        zero.alias("water_distance"),
        zero.alias("gps_distance"),
        F.lit(False).alias("is_swept"),
        F.lit(1).alias("completion_type"),
        F.coalesce("bin_longitude", zero).alias("bin_longitude"),
        F.coalesce("bin_latitude", zero).alias("bin_latitude"),
        "vehicle_id",
        F.col("imei").try_cast("bigint").alias("device"),
    )


def missing_summaries(staged: DataFrame, stop_summaries: DataFrame) -> DataFrame:
    """Staged summaries of stops that have none."""
    return staged.join(stop_summaries.select("stop_id"), "stop_id", "left_anti")


# ---- unplanned tags ----------------------------------------------------------


def latest_tag_events(matches: DataFrame, bins: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Event of each unplanned tag (case 7) with a live bin and a live vehicle."""
    live_bins = bins.where(~F.col("is_deleted")).select(tag_key(F.col("tag")).alias("tag_key"), F.col("id").alias("bin_id"))
    live_vehicles = vehicles.where(~F.col("is_deleted")).select(F.col("id").alias("vehicle_id"))
    return (
        _in_case(matches, 7)
        .join(live_bins, "tag_key")
        .join(live_vehicles, "vehicle_id", "left_semi")
        .select("ping_id", "tag", "tag_key", "imei", "vehicle_id", "bin_id", F.col("movement_time").alias("created_date"))
    )


def bin_last_completion(bins: DataFrame, matches: DataFrame) -> DataFrame:
    """Live bins of unplanned tags take the latest time of the tag."""
    latest = _in_case(matches, 7).groupBy("tag_key").agg(F.max("movement_time").alias("latest"))
    return (
        bins.withColumn("tag_key", tag_key(F.col("tag")))
        .join(latest, "tag_key", "left")
        .withColumn(
            "last_completion",
            F.when(F.col("latest").isNotNull() & ~F.col("is_deleted"), F.col("latest")).otherwise(
                F.col("last_completion")
            ),
        )
        .drop("tag_key", "latest")
    )


# ---- waste and trips ---------------------------------------------------------


def waste_records(matches: DataFrame, trip_summaries: DataFrame, vehicles: DataFrame, types: DataFrame) -> DataFrame:
    """Sensor reading and calibration of each lift of cases 1, 3 and 5."""
    calibration = vehicles.select(F.col("id").alias("vehicle_id"), "vehicle_type_id").join(
        types.select(
            F.col("id").alias("vehicle_type_id"), "full_weight", "empty_weight", "full_voltage", "empty_voltage"
        ),
        "vehicle_type_id",
    )
    return (
        _in_case(matches, 1, 3, 5)
        .select("ping_id", "case_no", "trip_id", "summary_id", "vehicle_id", "io9")
        .join(trip_summaries.select("trip_id"), "trip_id")
        .join(calibration, "vehicle_id")
        .drop("vehicle_type_id")
    )


def waste_per_trip(records: DataFrame) -> DataFrame:
    """Sum of the lifted weights; no reading, no voltage range or a negative weight counts as 0."""
    span = F.col("full_voltage") - F.col("empty_voltage")
    weight = ratio(F.col("full_weight") - F.col("empty_weight"), span) * (F.col("io9") - F.col("empty_voltage"))
    counted = F.when(F.col("io9").isNull() | (span == 0) | (weight < 0), 0.0).otherwise(weight)
    return records.groupBy("trip_id").agg(F.sum(counted).alias("waste"))


def trip_lift_context(matches: DataFrame, fleet) -> DataFrame:
    """Per trip with on-plan lifts: newly lifted, total, percent, and its plan and contract columns."""
    was_open = fleet.stop_summaries.select(F.col("id").alias("summary_id"), "bin_status")
    counted = (
        _in_case(matches, 1)
        .select("trip_id", "summary_id")
        .join(was_open, "summary_id")
        .groupBy("trip_id")
        .agg(F.count_if(F.col("bin_status") == BIN_OPEN).alias("new_lifts"))
    )
    services = (
        fleet.services.where(~F.col("is_deleted"))
        .select(F.col("id").alias("service_id"), "group_id", "group_type", F.col("contract_id").alias("owner_id"))
        .join(
            fleet.contracts.select(F.col("id").alias("owner_id"), "contract_type_id", "company_id"), "owner_id"
        )
        .join(fleet.contract_types.select(F.col("id").alias("contract_type_id")), "contract_type_id")
        .join(fleet.service_groups.select(F.col("id").alias("group_id")), "group_id")
        .drop("owner_id")
    )
    total = F.col("new_lifts") + F.col("actual_coverage")
    return (
        counted.join(fleet.trips.select(F.col("id").alias("trip_id"), "plan_id"), "trip_id")
        .join(
            fleet.trip_summaries.select(
                "trip_id", F.col("id").alias("trip_summary_id"), "expected_coverage", "actual_coverage"
            ),
            "trip_id",
        )
        .join(
            fleet.plans.select(
                F.col("id").alias("plan_id"), "service_id", "contract_id", "active_trips",
                F.col("completion_pct").alias("plan_old_pct"),
            ),
            "plan_id",
        )
        .join(services, "service_id")
        .withColumns({"total_lifts": total, "trip_pct": percent_2dp(total, F.col("expected_coverage"))})
    )


def lift_trip_state(
    trip_summaries: DataFrame, contexts: DataFrame, matches: DataFrame, waste: DataFrame, keep_known_waste: bool = False
) -> DataFrame:
    """Trip summaries after the lifts: coverage, percent up to 100, first start, waste.

    By default an unknown weight on either side makes the trip's waste unknown,
    as in the procedure; ``keep_known_waste`` counts it as 0.
    """
    first = _in_case(matches, 1).groupBy("trip_id").agg(F.min("movement_time").alias("first_lift"))
    new = (
        contexts.select(F.col("trip_summary_id").alias("id"), "trip_id", "total_lifts", "trip_pct")
        .join(first, "trip_id", "left")
        .join(waste, "trip_id", "left")
        .drop("trip_id")
    )
    touched = F.col("total_lifts").isNotNull()
    added = F.col("waste_weight") + F.col("waste")
    if keep_known_waste:
        added = F.coalesce("waste_weight", F.lit(0.0)) + F.coalesce("waste", F.lit(0.0))
    return (
        trip_summaries.join(new, "id", "left")
        .withColumns(
            {
                "waste_weight": F.when(touched, added).otherwise(F.col("waste_weight")),
                "actual_coverage": F.coalesce("total_lifts", "actual_coverage"),
                "completion_pct": F.when(touched, at_most_hundred(F.col("trip_pct").cast("double"))).otherwise(
                    F.col("completion_pct")
                ),
                "actual_start": F.coalesce("actual_start", "first_lift"),
                "status": F.when(touched, F.lit(STARTED_TRIP_SUMMARY)).otherwise(F.col("status")),
            }
        )
        .drop("total_lifts", "trip_pct", "first_lift", "waste")
    )


# ---- alerts ------------------------------------------------------------------


def outside_scope_events(matches: DataFrame, bins: DataFrame, vehicles: DataFrame, contract_types: DataFrame) -> DataFrame:
    """Off-plan lifts (cases 3, 4): category 1 if bin and vehicle have the same contract type, else 2."""
    owners = vehicles.select(
        F.col("id").alias("vehicle_id"), "plate", F.col("company_id").alias("vehicle_company_id"),
        F.col("contract_type_id").alias("vehicle_contract_type"),
    ).join(
        contract_types.select(F.col("id").alias("vehicle_contract_type"), F.col("name").alias("contract_name")),
        "vehicle_contract_type",
    )
    slots = bins.select(
        tag_key(F.col("tag")).alias("tag_key"),
        F.col("id").alias("bin_id"),
        F.col("tag").alias("container_slot"),
        F.col("contract_type_id").alias("bin_contract_type"),
    )
    same = F.col("bin_contract_type") == F.col("vehicle_contract_type")
    return (
        _in_case(matches, 3, 4)
        .select("ping_id", "case_no", "tag_key", "vehicle_id", "longitude", "latitude", "movement_time")
        .join(slots, "tag_key")
        .join(owners, "vehicle_id")
        .withColumn("category", F.when(same, SAME_SCOPE).otherwise(OTHER_SCOPE))
        .withColumnRenamed("movement_time", "lifted_at")
        .drop("bin_contract_type")
    )


def tag_location_violations(
    lifts: DataFrame, matches: DataFrame, references: DataFrame, bins: DataFrame, known: DataFrame,
    max_metres: float = MAX_METRES_FROM_REFERENCE,
) -> DataFrame:
    """Reads left over after cases 1 to 6 that lie too far from their tag's reference position.

    One row per bin of the tag; tags reported before are left out.
    """
    places = references.select(
        tag_key(F.col("tag")).alias("tag_key"),
        F.col("longitude").alias("ref_longitude"),
        F.col("latitude").alias("ref_latitude"),
    )
    owners = bins.select(
        tag_key(F.col("tag")).alias("tag_key"), F.col("id").alias("bin_id"),
        F.col("company_id").alias("bin_company_id"), F.col("contract_type_id").alias("bin_contract_type"),
    )
    metres = haversine_metres(F.col("latitude"), F.col("longitude"), F.col("ref_latitude"), F.col("ref_longitude"))
    return (
        lifts.select(F.col("id").alias("ping_id"), "tag", "tag_key", "vehicle_id", "longitude", "latitude", "movement_time")
        .join(matches.where("case_no <= 6").select("ping_id"), "ping_id", "left_anti")
        .join(known.select(tag_key(F.col("tag")).alias("tag_key")), "tag_key", "left_anti")
        .join(places, "tag_key")
        .withColumn("metres", metres)
        .where(F.col("metres") > max_metres)
        .join(owners, "tag_key")
        .drop("ref_longitude", "ref_latitude")
    )
