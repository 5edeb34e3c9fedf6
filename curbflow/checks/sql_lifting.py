"""SQL twins of the lifting jobs."""

from __future__ import annotations

from curbflow.checks.sql_views import view

view(
    "planned_tags",
    "select id as stop_id, trip_id, upper(rtrim(tag)) as tag_key, is_deleted from stops where tag is not null",
)
view("live_trips", "select * from trips where not is_deleted")
view(
    "taken_1",
    """
    select l.id as ping_id, 1 as case_no, t.id as trip_id, s.stop_id, ss.id as summary_id
    from lift_pings l join planned_tags s using (tag_key)
    join live_trips t on t.id = s.trip_id and t.vehicle_id = l.vehicle_id
        and l.movement_time between t.start_trip and t.end_trip
    join stop_summaries ss on ss.stop_id = s.stop_id
    """,
)
view("left_1", "select * from lift_pings where id not in (select ping_id from taken_1)")
view(
    "taken_2",
    """
    select ping_id, 2 as case_no, trip_id, b.stop_id, ss.id as summary_id
    from (
        select l.id as ping_id, t.id as trip_id, s.stop_id
        from left_1 l join planned_tags s using (tag_key)
        join live_trips t on t.id = s.trip_id and t.vehicle_id = l.vehicle_id and t.end_trip < l.movement_time
        qualify row_number() over (partition by l.id order by t.end_trip desc, t.id desc, s.stop_id desc) = 1
    ) b join stop_summaries ss on ss.stop_id = b.stop_id
    """,
)
view("left_2", "select * from left_1 where id not in (select ping_id from taken_2)")
view(
    "taken_3",
    """
    select ping_id, 3 as case_no, trip_id, cast(null as bigint) as stop_id, cast(null as bigint) as summary_id
    from (
        select l.id as ping_id, l.tag_key, t.id as trip_id
        from left_2 l join live_trips t on t.vehicle_id = l.vehicle_id
            and l.movement_time >= t.start_trip and l.movement_time < t.end_trip
        qualify row_number() over (partition by l.id order by t.start_trip desc, t.id desc) = 1
    ) b where not exists (select 1 from planned_tags s where s.trip_id = b.trip_id and s.tag_key = b.tag_key)
    """,
)
view("left_3", "select * from left_2 where id not in (select ping_id from taken_3)")
view(
    "taken_4",
    """
    select ping_id, 4 as case_no, trip_id, cast(null as bigint) as stop_id, cast(null as bigint) as summary_id
    from (
        select l.id as ping_id, l.tag_key, t.id as trip_id
        from left_3 l join live_trips t on t.vehicle_id = l.vehicle_id and t.end_trip < l.movement_time
        qualify row_number() over (partition by l.id order by t.end_trip desc, t.id desc) = 1
    ) b where not exists (select 1 from planned_tags s where s.trip_id = b.trip_id and s.tag_key = b.tag_key)
    """,
)
view("left_4", "select * from left_3 where id not in (select ping_id from taken_4)")
view(
    "taken_5",
    """
    select l.id as ping_id, 5 as case_no, t.id as trip_id, s.stop_id, cast(null as bigint) as summary_id
    from left_4 l join planned_tags s using (tag_key)
    join live_trips t on t.id = s.trip_id and t.vehicle_id <> l.vehicle_id
        and l.movement_time >= t.start_trip and l.movement_time < t.end_trip
    qualify row_number() over (partition by l.id order by t.start_trip desc, t.id desc, s.stop_id desc) = 1
    """,
)
view("left_5", "select * from left_4 where id not in (select ping_id from taken_5)")
view(
    "taken_6",
    """
    select l.id as ping_id, 6 as case_no, t.id as trip_id, s.stop_id, cast(null as bigint) as summary_id
    from left_5 l join planned_tags s using (tag_key)
    join live_trips t on t.id = s.trip_id and t.vehicle_id <> l.vehicle_id and t.end_trip < l.movement_time
    qualify row_number() over (partition by l.id order by t.end_trip desc, t.id desc, s.stop_id desc) = 1
    """,
)
view("left_6", "select * from left_5 where id not in (select ping_id from taken_6)")
view(
    "taken_7",
    """
    select id as ping_id, 7 as case_no, cast(null as bigint) as trip_id, cast(null as bigint) as stop_id,
        cast(null as bigint) as summary_id
    from left_6 where tag_key not in (select tag_key from planned_tags)
    """,
)
view(
    "lift_cases",
    " union all ".join(f"select * from taken_{n}" for n in range(1, 8)),
)
view(
    "lift_matches",
    "select c.*, l.* exclude (id) from lift_cases c join lift_pings l on l.id = c.ping_id",
)

# ---- effects -----------------------------------------------------------------

view(
    "best_bins",
    """
    select upper(rtrim(tag)) as tag_key, id as bin_id, longitude, latitude from bins
    qualify row_number() over (partition by upper(rtrim(tag))
        order by modified_date desc nulls last, created_date desc nulls last, id) = 1
    """,
)
view(
    "best_geometry",
    """
    select upper(rtrim(tag)) as tag_key, id as geometry_id from streets where tag is not null
    qualify row_number() over (partition by upper(rtrim(tag))
        order by modified_date desc nulls last, created_date desc nulls last, id) = 1
    """,
)
view(
    "added_stops",
    """
    select m.case_no, m.trip_id, m.tag_key, b.bin_id, g.geometry_id, min(m.movement_time) as created_date,
        max(m.imei) as imei, max(m.vehicle_id) as vehicle_id, any_value(b.longitude) as bin_longitude,
        any_value(b.latitude) as bin_latitude
    from lift_matches m join best_bins b using (tag_key) left join best_geometry g using (tag_key)
    where m.case_no in (3, 4) and not exists (
        select 1 from planned_tags s join live_trips t on t.id = s.trip_id
        where s.trip_id = m.trip_id and s.tag_key = m.tag_key and not s.is_deleted)
    group by all
    """,
)


def lifted_state(case_no: int, condition: str, source: str = "lift_matches") -> str:
    """State of every stop summary after one case; ``condition`` says which may change."""
    status = 12 + case_no
    return f"""
    select s.id,
        cast(case when r.ping_id is not null and s.bin_status = 1 then 2 else s.bin_status end as int) as bin_status,
        case when r.ping_id is not null and s.bin_status = 1 then r.movement_time else s.completion_time end
            as completion_time,
        case when r.ping_id is null then s.last_completion
            when s.bin_status = 1 then r.movement_time
            when date_diff('minute', s.last_completion, r.movement_time) >= 60 then r.movement_time
            else s.last_completion end as last_completion,
        case when r.ping_id is null then s.lifts
            when s.bin_status = 1 then 1
            when date_diff('minute', s.last_completion, r.movement_time) >= 60 then s.lifts + 1
            else s.lifts end as lifts,
        case when r.ping_id is null then s.status_lookup else {status} end as status_lookup,
        coalesce(r.vehicle_id, s.vehicle_id) as vehicle_id,
        case when r.ping_id is null then s.device else try_cast(r.imei as bigint) end as device
    from stop_summaries s
    left join {source} r on r.summary_id = s.id and r.case_no = {case_no} and ({condition})
    """


view(
    "other_vehicle_hits",
    """
    select m.* exclude (summary_id), ss.id as summary_id
    from lift_matches m join stop_summaries ss on ss.stop_id = m.stop_id where case_no in (5, 6)
    """,
)
view(
    "waste_rows",
    """
    select m.ping_id, m.case_no, m.trip_id, m.summary_id, m.io9, vt.full_weight, vt.empty_weight, vt.full_voltage,
        vt.empty_voltage
    from lift_matches m join trip_summaries ts on ts.trip_id = m.trip_id
    join vehicles v on v.id = m.vehicle_id join vehicle_types vt on vt.id = v.vehicle_type_id
    where m.case_no in (1, 3, 5)
    """,
)
view(
    "waste_sums",
    """
    select trip_id, sum(case when io9 is null or full_voltage = empty_voltage then 0 else greatest(0,
        (full_weight - empty_weight) / (full_voltage - empty_voltage) * (io9 - empty_voltage)) end) as waste
    from waste_rows group by trip_id
    """,
)
view(
    "lift_contexts",
    """
    select t.id as trip_id, ts.id as trip_summary_id, t.plan_id, p.service_id, p.contract_id, sv.group_id,
        sv.group_type, c.contract_type_id, c.company_id, p.active_trips, p.completion_pct as plan_old_pct,
        ts.expected_coverage, ts.actual_coverage, m.new_lifts,
        m.new_lifts + ts.actual_coverage as total_lifts,
        round((m.new_lifts + ts.actual_coverage) * 100 / nullif(ts.expected_coverage, 0), 2) as trip_pct
    from (
        select trip_id, count(*) filter (where ss.bin_status = 1) as new_lifts
        from taken_1 join stop_summaries ss on ss.id = summary_id group by trip_id
    ) m
    join trips t on t.id = m.trip_id join trip_summaries ts on ts.trip_id = t.id
    join plans p on p.id = t.plan_id join services sv on sv.id = p.service_id and not sv.is_deleted
    join contracts c on c.id = sv.contract_id join contract_types ct on ct.id = c.contract_type_id
    join service_groups g on g.id = sv.group_id
    """,
)
view(
    "lifted_trips",
    """
    select ts.id, ts.trip_id,
        case when c.trip_id is null then ts.waste_weight else ts.waste_weight + w.waste end as waste_weight,
        coalesce(c.total_lifts, ts.actual_coverage) as actual_coverage,
        case when c.trip_id is null then ts.completion_pct when c.trip_pct > 100 then 100 else c.trip_pct
            end as completion_pct,
        case when c.trip_id is null then ts.actual_start else coalesce(ts.actual_start, f.first_lift) end
            as actual_start,
        cast(case when c.trip_id is null then ts.status else 2 end as int) as status
    from trip_summaries ts left join lift_contexts c on c.trip_summary_id = ts.id
    left join waste_sums w on w.trip_id = ts.trip_id
    left join (select trip_id, min(movement_time) as first_lift from lift_matches where case_no = 1 group by 1) f
        on f.trip_id = ts.trip_id
    """,
)
