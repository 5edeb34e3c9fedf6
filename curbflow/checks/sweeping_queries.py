"""Queries of position reads: the split of the batch and street sweeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbflow.checks.registry import DIGITS, query, r_sql, rounded
from curbflow.plans import sweeping
from curbflow.plans.sweep_rules import LEGACY
from curbflow.sources import pings as ping_source

# ---- pings -------------------------------------------------------------------


@query(
    "ping_lift_reads",
    "select id, vehicle_id, tag_key, movement_time, contract_type_id, company_id, tenant_id from lift_pings",
)
def ping_lift_reads(batch):
    return ping_source.lift_reads(batch.fleet.pings, batch.fleet.vehicles).select(
        "id", "vehicle_id", "tag_key", "movement_time", "contract_type_id", "company_id", "tenant_id"
    )


@query("ping_sweep_reads", "select id, vehicle_id, movement_time, speed from sweep_pings")
def ping_sweep_reads(batch):
    return ping_source.sweep_reads(batch.fleet.pings).select("id", "vehicle_id", "movement_time", "speed")


@query("ping_overlong_tags", "select id, tag from pings where trim(tag) <> '' and length(rtrim(tag)) > 30")
def ping_overlong_tags(batch):
    return ping_source.overlong_tags(batch.fleet.pings).select("id", "tag")


@query(
    "tag_reference_first_seen",
    f"""select tag_key, {r_sql("longitude", "latitude")} from lift_pings l
    where not exists (select 1 from tag_references r where upper(rtrim(r.tag)) = l.tag_key)""",
)
def tag_reference_first_seen(batch):
    lifts = ping_source.lift_reads(batch.fleet.pings, batch.fleet.vehicles)
    return ping_source.new_tag_references(lifts, batch.fleet.tag_references).select(
        "tag_key", *rounded("longitude", "latitude")
    )


# ---- sweeping ----------------------------------------------------------------

LOCATION_IDS = ("ping_id", "trip_id", "stop_summary_id", "vehicle_id")


PROXIMITY = (
    *LOCATION_IDS, "trip_summary_id", "plan_id", "service_id", "contract_id", "group_id", "group_type",
    "contract_type_id", "company_id", "vehicle_type", "company_type", "active_trips",
)


@query(
    "street_proximity",
    f"select {', '.join(PROXIMITY)}, movement_time, round(distance, 6) as distance from near_streets",
)
def street_proximity(batch):
    return batch.locations.select(*PROXIMITY, "movement_time", F.round("distance", 6).alias("distance"))


POSITIONS = ("longitude", "latitude", "last_longitude", "last_latitude")


@query("ping_segments", f"select {', '.join(LOCATION_IDS)}, {r_sql(*POSITIONS)} from sweep_segments")
def ping_segments(batch):
    return sweeping.ping_segments(batch.locations).select(*LOCATION_IDS, *rounded(*POSITIONS))


@query("segment_haversine", f"select {', '.join(LOCATION_IDS)}, {r_sql('metres')} from sweep_metres")
def segment_haversine(batch):
    measured = sweeping.segment_metres(sweeping.ping_segments(batch.locations)).where("metres is not null")
    return measured.select(*LOCATION_IDS, *rounded("metres"))


FLAGS = ("gps_on", "water_on", "brush_on", "side_on")


@query("sweep_validity_flags", f"select {', '.join(LOCATION_IDS + FLAGS)} from sweep_flags")
def sweep_validity_flags(batch):
    segments = sweeping.segment_metres(sweeping.ping_segments(batch.locations)).where("metres is not null")
    return sweeping.validity_flags(segments).select(*LOCATION_IDS, *FLAGS)


STREET_IDS = ("trip_id", "stop_summary_id", "vehicle_type", "company_type")
STREET_METRES = ("valid_metres", "water_metres", "brush_metres", "gps_metres")


@query("street_distance_agg", f"select {', '.join(STREET_IDS)}, {r_sql(*STREET_METRES)} from street_sums")
def street_distance_agg(batch):
    return sweeping.street_distances(batch.totals).select(*STREET_IDS, *rounded(*STREET_METRES))


@query("street_completion", f"select {', '.join(STREET_IDS)}, {r_sql('completion')} from street_results")
def street_completion(batch):
    return batch.streets.select(*STREET_IDS, *rounded("completion"))


STOP_STATE = ("total_distance", "completion_pct", "brush_distance", "water_distance", "gps_distance")


@query("street_state_update", f"select id, is_swept, {r_sql(*STOP_STATE)} from swept_summaries")
def street_state_update(batch):
    state = sweeping.street_state(batch.fleet.stop_summaries, batch.streets)
    return state.select("id", "is_swept", *rounded(*STOP_STATE))


def _swept_alone(batch):
    """Swept trips of a batch without lifts."""
    state = sweeping.street_state(batch.fleet.stop_summaries, batch.streets)
    return sweeping.swept_trips(batch.streets, state, batch.fleet)


TRIP_IDS = ("trip_id", "trip_summary_id", "plan_id", "service_id", "contract_id", "group_id", "active_trips")


@query(
    "trip_weighted_completion",
    f"select {', '.join(TRIP_IDS)}, {r_sql('plan_old_pct', 'trip_pct', 'valid_metres')} from swept_trip_results",
)
def trip_weighted_completion(batch):
    return _swept_alone(batch).select(*TRIP_IDS, *rounded("plan_old_pct", "trip_pct", "valid_metres"))


@query(
    "trip_sweep_update",
    f"""select ts.id, round(case when r.trip_id is null then completion_pct else trip_pct end, {DIGITS})
            as completion_pct, coalesce(actual_start, first_ping) as actual_start,
        round(actual_coverage + coalesce(valid_metres, 0), {DIGITS}) as actual_coverage
    from trip_summaries ts left join swept_trip_results r on r.trip_summary_id = ts.id
    left join (select trip_id, min(movement_time) as first_ping from sweep_segments group by trip_id) f
        on f.trip_id = r.trip_id""",
)
def trip_sweep_update(batch):
    return sweeping.sweep_trip_state(batch.fleet.trip_summaries, _swept_alone(batch), batch.totals).select(
        "id", "actual_start", *rounded("completion_pct", "actual_coverage")
    )


@query("sweep_ruleset_legacy", f"select {', '.join(STREET_IDS)}, {r_sql(*STREET_METRES, 'completion')} from street_legacy_results")
def sweep_ruleset_legacy(batch):
    return sweeping.swept_streets(batch.locations, LEGACY).select(*STREET_IDS, *rounded(*STREET_METRES, "completion"))
