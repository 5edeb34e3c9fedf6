"""Queries of tag reads: matching and its effects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbflow.checks import sql_lifting
from curbflow.checks.registry import query, r_sql, rounded
from curbflow.checks.sql_views import view
from curbflow.plans import lifting, matching

MATCH = matching.MATCH


def _taken(batch, case_no: int) -> DataFrame:
    return batch.cases.where(f"case_no = {case_no}").select(*MATCH)


CASE_NAMES = {
    2: "lift_case2_late_on_plan",
    3: "lift_case3_off_plan",
    4: "lift_case4_late_off_plan",
    5: "lift_case5_other_vehicle",
    6: "lift_case6_other_vehicle_late",
}


@query("lift_case1_on_plan", f"select {', '.join(MATCH)} from taken_1")
def lift_case1(batch):
    return matching.on_plan(batch.hits, batch.fleet.stop_summaries).select(*MATCH)


for _case, _name in CASE_NAMES.items():
    query(_name, f"select {', '.join(MATCH)} from taken_{_case}")(lambda batch, case=_case: _taken(batch, case))


@query("lift_case7_unplanned", "select ping_id, case_no from taken_7")
def lift_case7(batch):
    return _taken(batch, 7).select("ping_id", "case_no")


@query("lift_case_cascade", f"select {', '.join(MATCH)} from lift_cases")
def lift_case_cascade(batch):
    return batch.cases.select(*MATCH)


# ---- places ------------------------------------------------------------------

NO_LABEL = "coalesce(modified_by, '-') as modified_by"


@query(
    "bin_location_update",
    f"""select b.id, {r_sql("longitude", "latitude")}, {NO_LABEL} from (
        select b.id, coalesce(m.longitude, b.longitude) as longitude, coalesce(m.latitude, b.latitude) as latitude,
            'lift_case_' || m.case_no as modified_by
        from bins b left join (select distinct tag_key, case_no, longitude, latitude from lift_matches
            where case_no <> 6) m on m.tag_key = upper(rtrim(b.tag)) and not b.is_deleted) b""",
)
def bin_location_update(batch):
    return lifting.bin_location_update(batch.fleet.bins, batch.matches).select(
        "id", *rounded("longitude", "latitude"), F.coalesce("modified_by", F.lit("-")).alias("modified_by")
    )


@query(
    "geometry_location_update",
    f"""select id, {r_sql("longitude", "latitude")} from (
        select s.id, m.longitude, m.latitude from streets s
        join (select distinct tag_key, longitude, latitude from lift_matches where case_no = 1) m
            on m.tag_key = upper(rtrim(s.tag)) where not s.is_deleted)""",
)
def geometry_location_update(batch):
    moved = lifting.geometry_location_update(batch.fleet.streets, batch.matches)
    return moved.where("modified_by is not null").select("id", *rounded("longitude", "latitude"))


def _tags(batch) -> DataFrame:
    return batch.lifts.select("tag_key")


@query(
    "top_bin_per_tag",
    "select tag_key, bin_id from best_bins where tag_key in (select tag_key from lift_pings)",
)
def top_bin_per_tag(batch):
    return lifting.top_bin_per_tag(batch.fleet.bins, _tags(batch)).select("tag_key", "bin_id")


@query(
    "top_geometry_per_tag",
    "select tag_key, geometry_id from best_geometry where tag_key in (select tag_key from lift_pings)",
)
def top_geometry_per_tag(batch):
    return lifting.top_geometry_per_tag(batch.fleet.streets, _tags(batch))


# ---- stop summaries ----------------------------------------------------------

STATE = (
    "id", "bin_status", "completion_time", "last_completion", "lifts", "status_lookup", "vehicle_id", "device",
)


@query("lift_state_case1", sql_lifting.lifted_state(1, "s.status_lookup = 13"))
def lift_state_case1(batch):
    return lifting.lift_state_case1(batch.fleet.stop_summaries, batch.matches).select(*STATE)


@query("lift_state_case1_intended", sql_lifting.lifted_state(1, "s.status_lookup is null or s.status_lookup = 13"))
def lift_state_case1_intended(batch):
    return lifting.lift_state_case1(batch.fleet.stop_summaries, batch.matches, strict_nulls=False).select(*STATE)


@query("lift_state_case2", sql_lifting.lifted_state(2, "s.status_lookup is null or s.status_lookup = 14"))
def lift_state_case2(batch):
    return lifting.lift_state_case2(batch.fleet.stop_summaries, batch.matches).select(*STATE)


for _case in (5, 6):
    query(f"lift_state_case{_case}", sql_lifting.lifted_state(_case, "s.status_lookup is null", "other_vehicle_hits"))(
        lambda batch, case=_case: lifting.lift_state_other_vehicle(
            batch.fleet.stop_summaries, batch.matches, case
        ).select(*STATE)
    )


def _added(batch, case_no: int) -> DataFrame:
    return batch.added_stops.where(F.col("case_no") == case_no)


NEW_STOP = ("trip_id", "tag_key", "bin_id", "geometry_id", "created_date")
for _case in (3, 4):
    query(
        f"off_plan_stops_case{_case}",
        f"select {', '.join(NEW_STOP)}, -1 as stop_order from added_stops where case_no = {_case}",
    )(lambda batch, case=_case: _added(batch, case).select(*NEW_STOP, "stop_order"))

    def _summary_rows(batch, case=_case):
        stops = _added(batch, case)
        rows = lifting.off_plan_summaries(stops)
        return rows.join(stops.select(F.col("id").alias("stop_id"), "trip_id", "tag_key"), "stop_id").select(
            "trip_id", "tag_key", "bin_status", "status_lookup", "lifts", "last_completion", "device", "vehicle_id",
            *rounded("bin_longitude", "bin_latitude"),
        )

    query(
        f"off_plan_summary_case{_case}",
        f"""select trip_id, tag_key, 2 as bin_status, {12 + _case} as status_lookup, 1 as lifts,
            created_date as last_completion, try_cast(imei as bigint) as device, vehicle_id,
            {r_sql("bin_longitude", "bin_latitude")} from added_stops where case_no = {_case}""",
    )(_summary_rows)


@query(
    "stop_insert_missing",
    f"""select a.trip_id, a.tag_key, 2 as bin_status, 12 + a.case_no as status_lookup, a.created_date as last_completion,
        a.vehicle_id, {r_sql("bin_longitude", "bin_latitude")}
    from added_stops a where not exists (
        select 1 from stops s join stop_summaries x on x.stop_id = s.id
        where s.trip_id = a.trip_id and upper(rtrim(s.tag)) = a.tag_key)""",
)
def stop_insert_missing(batch):
    """The staged summaries of off-plan stops whose stop has none."""
    staged = lifting.off_plan_summaries(batch.added_stops, batch.fleet.stop_summaries.schema["id"].dataType)
    rows = lifting.missing_summaries(staged, batch.fleet.stop_summaries)
    return rows.join(batch.added_stops.select(F.col("id").alias("stop_id"), "trip_id", "tag_key"), "stop_id").select(
        "trip_id", "tag_key", "bin_status", "status_lookup", "last_completion", "vehicle_id", *rounded("bin_longitude", "bin_latitude")
    )


# ---- unplanned tags ----------------------------------------------------------


@query(
    "latest_tag_event",
    """select m.ping_id, m.tag_key, m.vehicle_id, b.id as bin_id, m.movement_time as created_date
    from lift_matches m join bins b on upper(rtrim(b.tag)) = m.tag_key and not b.is_deleted
    join vehicles v on v.id = m.vehicle_id and not v.is_deleted where m.case_no = 7""",
)
def latest_tag_event(batch):
    return lifting.latest_tag_events(batch.matches, batch.fleet.bins, batch.fleet.vehicles).select(
        "ping_id", "tag_key", "vehicle_id", "bin_id", "created_date"
    )


@query(
    "bin_last_completion",
    """select b.id, case when m.latest is not null and not b.is_deleted then m.latest else b.last_completion end
        as last_completion
    from bins b left join (select tag_key, max(movement_time) as latest from lift_matches where case_no = 7 group by 1)
        m on m.tag_key = upper(rtrim(b.tag))""",
)
def bin_last_completion(batch):
    return lifting.bin_last_completion(batch.fleet.bins, batch.matches).select("id", "last_completion")


# ---- waste and trips ---------------------------------------------------------


def _waste_records(batch) -> DataFrame:
    fleet = batch.fleet
    return lifting.waste_records(batch.matches, fleet.trip_summaries, fleet.vehicles, fleet.vehicle_types)


@query(
    "waste_records",
    f"""select ping_id, case_no, trip_id, {r_sql("io9", "full_weight", "empty_weight", "full_voltage",
        "empty_voltage")} from waste_rows""",
)
def waste_records(batch):
    return _waste_records(batch).select(
        "ping_id", "case_no", "trip_id",
        *rounded("io9", "full_weight", "empty_weight", "full_voltage", "empty_voltage"),
    )


@query("waste_weight_per_trip", f"select trip_id, {r_sql('waste')} from waste_sums")
def waste_weight_per_trip(batch):
    return lifting.waste_per_trip(_waste_records(batch)).select("trip_id", *rounded("waste"))


CONTEXT = (
    "trip_id", "trip_summary_id", "plan_id", "service_id", "contract_id", "group_id", "group_type",
    "contract_type_id", "company_id", "active_trips", "new_lifts", "total_lifts",
)


@query("trip_lift_context", f"select {', '.join(CONTEXT)}, cast(trip_pct as double) as trip_pct from lift_contexts")
def trip_lift_context(batch):
    return batch.lift_contexts.select(
        *CONTEXT, F.col("trip_pct").cast("double").alias("trip_pct")
    )


TRIP_STATE = ("waste_weight", "actual_coverage", "completion_pct")


@query("trip_lift_update", f"select id, actual_start, status, {r_sql(*TRIP_STATE)} from lifted_trips")
def trip_lift_update(batch):
    return lifting.lift_trip_state(
        batch.fleet.trip_summaries, batch.lift_contexts, batch.matches, batch.waste
    ).select("id", "actual_start", "status", *rounded(*TRIP_STATE))


# ---- alerts ------------------------------------------------------------------

EVENT = ("ping_id", "case_no", "bin_id", "vehicle_id", "plate", "container_slot", "contract_name", "lifted_at", "category")


@query(
    "lift_outside_scope_events",
    f"""select {', '.join(EVENT)}, {r_sql("longitude", "latitude")} from (
        select m.ping_id, m.case_no, b.id as bin_id, v.id as vehicle_id, v.plate, b.tag as container_slot,
            ct.name as contract_name, m.movement_time as lifted_at,
            case when b.contract_type_id = v.contract_type_id then 1 else 2 end as category,
            m.longitude, m.latitude
        from lift_matches m join bins b on upper(rtrim(b.tag)) = m.tag_key join vehicles v on v.id = m.vehicle_id
        join contract_types ct on ct.id = v.contract_type_id where m.case_no in (3, 4))""",
)
def lift_outside_scope_events(batch):
    events = lifting.outside_scope_events(batch.matches, batch.fleet.bins, batch.fleet.vehicles, batch.fleet.contract_types)
    return events.select(*EVENT, *rounded("longitude", "latitude"))


view(
    "new_violations",
    """
    select l.id as ping_id, l.tag_key, l.vehicle_id, b.id as bin_id, l.movement_time, l.longitude, l.latitude
    from left_6 l join tag_references r on upper(rtrim(r.tag)) = l.tag_key
    join bins b on upper(rtrim(b.tag)) = l.tag_key
    where 2 * 6371000 * asin(sqrt(
            pow(sin(radians(l.latitude - r.latitude) / 2), 2)
            + cos(radians(l.latitude)) * cos(radians(r.latitude))
                * pow(sin(radians(l.longitude - r.longitude) / 2), 2))) > 5
        and l.tag_key not in (select upper(rtrim(tag)) from tag_violations)
    """,
)


@query(
    "tag_location_violations",
    f"""select ping_id, tag_key, vehicle_id, bin_id, movement_time, {r_sql("longitude", "latitude")} from new_violations""",
)
def tag_location_violations(batch):
    found = lifting.tag_location_violations(
        batch.lifts, batch.matches, batch.fleet.tag_references, batch.fleet.bins, batch.fleet.tag_violations
    )
    return found.select(
        "ping_id", "tag_key", "vehicle_id", "bin_id", "movement_time", *rounded("longitude", "latitude")
    )
