"""Queries of trip creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbflow.checks import sql_trips  # noqa: F401
from curbflow.checks.registry import NOW, TODAY, query, r_sql, rounded
from curbflow.plans import trip_creation
from curbflow.plans.trip_creation import TripRun


def _run(batch) -> TripRun:
    return TripRun(batch.fleet, TODAY, NOW)


@query("plans_due_today", "select id, service_id, is_monthly from due_plans")
def plans_due_today(batch):
    return _run(batch).due.select("id", "service_id", "is_monthly")


@query("weekly_next_starts", "select plan_id, start_trip from weekly_plan_starts")
def weekly_next_starts(batch):
    return _run(batch).weekly


@query("monthly_starts", "select plan_id, start_trip from monthly_plan_starts")
def monthly_starts(batch):
    return _run(batch).monthly


@query(
    "existing_trips",
    """select t.plan_id, t.start_trip, t.id as trip_id from trips t
    join plan_starts s on s.plan_id = t.plan_id and s.start_trip = t.start_trip where not t.is_deleted""",
)
def existing_trips(batch):
    return trip_creation.existing_trips(_run(batch).starts, batch.fleet.trips)


@query("trips_to_create", "select plan_id, start_trip from wanted_starts")
def trips_to_create(batch):
    return _run(batch).to_create


TRIP = ("plan_id", "start_trip", "end_trip", "driver_id", "vehicle_id", "reference_code")


@query("trip_build", f"select {', '.join(TRIP)}, 1 as status from made_trips")
def trip_build(batch):
    return _run(batch).trips.select(*TRIP, "status")


def _with_code(rows: DataFrame, run: TripRun) -> DataFrame:
    """New rows have new ids; the reference code of the trip stands for them in the comparison."""
    return rows.join(run.trips.select(F.col("id").alias("trip_id"), F.col("reference_code").alias("trip_code")), "trip_id")


@query(
    "trip_summary_init",
    """select t.reference_code as trip_code, p.expected_coverage, 5 as status, 2 as discharge_status
    from due_plans p join made_trips t on t.plan_id = p.id""",
)
def trip_summary_init(batch):
    run = _run(batch)
    return _with_code(run.summaries, run).select("trip_code", "expected_coverage", "status", "discharge_status")


@query(
    "trip_localizations",
    """select t.reference_code as trip_code, x.locale, coalesce(x.description, '') || ' - ' || w.name || ' - '
        || strftime(t.start_trip, '%Y-%m-%d %I:%M') as description
    from due_plans p join made_trips t on t.plan_id = p.id join plan_texts x on x.plan_id = p.id
    join weekdays w on w.day = dayofweek(t.start_trip)""",
)
def trip_localizations(batch):
    run = _run(batch)
    return _with_code(run.texts, run).select("trip_code", "locale", "description")


STOP = ("trip_code", "tag", "bin_id", "stop_order", "geometry_id")


@query(
    "trip_stops_build",
    f"""select {', '.join(STOP)}, coalesce(reference_code, '-') as reference_code,
        {r_sql("street_weight", "street_length")},
        sha256(unhex(regexp_replace(hex(tag), '(..)', '\\100', 'g'))) as tag_hash from made_stops""",
)
def trip_stops_build(batch):
    run = _run(batch)
    stops = run.stops.withColumn("reference_code", F.coalesce("reference_code", F.lit("-")))
    return _with_code(stops, run).select(*STOP, "reference_code", "tag_hash", *rounded("street_weight", "street_length"))


@query(
    "stop_summary_init",
    f"""select s.trip_code, s.tag, s.stop_order, 1 as bin_status,
        round(coalesce(b.longitude, 0), 4) as bin_longitude, round(coalesce(b.latitude, 0), 4) as bin_latitude
    from made_stops s join made_trips t on t.reference_code = s.trip_code join due_plans p on p.id = t.plan_id
    left join bins b on b.id = s.bin_id""",
)
def stop_summary_init(batch):
    run = _run(batch)
    stops = run.stops.select(F.col("id").alias("stop_id"), "trip_id", "tag", "stop_order").distinct()
    rows = run.stop_summaries.join(stops, "stop_id")
    return _with_code(rows, run).select(
        "trip_code", "tag", "stop_order", "bin_status", *rounded("bin_longitude", "bin_latitude")
    )


@query(
    "duplicate_tags_in_trip",
    """select trip_code, tag as tag_key, place from (
        select trip_code, tag, row_number() over (partition by trip_code, tag) as place from made_stops
    ) where place > 1""",
)
def duplicate_tags_in_trip(batch):
    run = _run(batch)
    return _with_code(trip_creation.duplicate_tags(run.stops), run).select("trip_code", "tag_key", "place")


@query(
    "new_trips_report",
    """select case when p.is_monthly then 'monthly' else 'weekly' end as kind, s.plan_id, s.start_trip, p.created_date
    from wanted_starts s join plans p on p.id = s.plan_id""",
)
def new_trips_report(batch):
    run = _run(batch)
    weekly, monthly = (
        trip_creation.new_trips_report(run.to_create, batch.fleet.plans, flag).withColumn("kind", F.lit(kind))
        for flag, kind in ((False, "weekly"), (True, "monthly"))
    )
    both = weekly.unionByName(monthly).orderBy(F.desc("kind"), "created_date", "plan_id", "start_trip")
    return both.select("kind", "plan_id", "start_trip", "created_date")


@query(
    "plan_active_trips",
    """select p.id, case when p.id in (select plan_id from plan_starts) then coalesce(c.started, 0)
        else p.active_trips end as active_trips
    from plans p left join (
        select plan_id, count(*) as started from (
            select plan_id, start_trip from trips union all select plan_id, start_trip from made_trips
        ) where start_trip <= timestamp '2024-01-10 09:30:00' group by plan_id
    ) c on c.plan_id = p.id""",
)
def plan_active_trips(batch):
    return _run(batch).plans.select("id", "active_trips")


@query(
    "trip_status_advance",
    """select plan_id, start_trip, end_trip,
        case when status = 1 and start_trip <= timestamp '2024-01-10 10:30:00' then 3 else status end as status
    from (select plan_id, start_trip, end_trip, status from trips
        union all select plan_id, start_trip, end_trip, 1 from made_trips)""",
)
def trip_status_advance(batch):
    """Stored trips and those the run creates."""
    return _run(batch).all_trips.select("plan_id", "start_trip", "end_trip", "status")


@query(
    "crew_assign",
    """select t.plan_id, t.start_trip, c.crew_id from trips t join crew_plans c on c.plan_id = t.plan_id
    where not t.is_deleted and not exists (select 1 from crew_trips x
        where x.trip_id = t.id and x.crew_id = c.crew_id and not x.is_deleted)
    union all
    select t.plan_id, t.start_trip, c.crew_id from made_trips t join crew_plans c on c.plan_id = t.plan_id""",
)
def crew_assign(batch):
    """Crews of stored trips and of those the run creates."""
    run = _run(batch)
    trips = run.all_trips.select(F.col("id").alias("trip_id"), "plan_id", "start_trip")
    return run.crews.join(trips, "trip_id").select("plan_id", "start_trip", "crew_id")


@query(
    "trip_tables_append",
    """select plan_id, start_trip, end_trip, case when is_new then 'new' else 'stored' end as origin from (
        select plan_id, start_trip, end_trip, false as is_new from trips
        union all select plan_id, start_trip, end_trip, true from made_trips)""",
)
def trip_tables_append(batch):
    origin = F.when(F.col("reference_code").isNotNull(), "new").otherwise("stored").alias("origin")
    return _run(batch).all_trips.select("plan_id", "start_trip", "end_trip", origin)


STORED_STOP = ("tag", "stop_order", "street_weight", "street_length", "geometry_id")


@query(
    "trip_stops_append",
    f"""select {", ".join(STORED_STOP)}, 'stored' as origin from stops
    union all select {", ".join(STORED_STOP)}, 'new' from made_stops""",
)
def trip_stops_append(batch):
    stored = batch.fleet.stops.select(*STORED_STOP, F.lit("stored").alias("origin"))
    return stored.unionByName(_run(batch).stops.select(*STORED_STOP, F.lit("new").alias("origin")))


@query(
    "trip_summaries_append",
    """select cast(expected_coverage as double) as expected_coverage, actual_coverage, completion_pct, status, 'stored' as origin
    from trip_summaries
    union all select cast(p.expected_coverage as double), 0, 0, 5, 'new' from made_trips t join due_plans p on p.id = t.plan_id""",
)
def trip_summaries_append(batch):
    columns = (F.col("expected_coverage").cast("double").alias("expected_coverage"), "actual_coverage", "completion_pct", "status")
    stored = batch.fleet.trip_summaries.select(*columns, F.lit("stored").alias("origin"))
    return stored.unionByName(_run(batch).summaries.select(*columns, F.lit("new").alias("origin")))
