"""Named SELECTs in DuckDB SQL; ``statement`` puts the ones a query needs into a WITH list.

They state each result the plain way (correlated lookups, direct distance
checks), independent of how the Spark jobs reach it.
"""

from __future__ import annotations

import re

from curbflow.sources.derived import TABLES, duckdb_ctes

VIEWS: dict[str, str] = {}


def view(name: str, text: str) -> None:
    VIEWS[name] = text.strip()


def _names_in(text: str) -> set[str]:
    return set(re.findall(r"[a-z_][a-z_0-9]*", text))


def statement(text: str) -> str:
    """``text`` with every view and table it needs, directly or not, put before it."""
    ordered: dict[str, str] = {}

    def need(body: str) -> None:
        words = _names_in(body)
        for name in VIEWS:
            if name in words and name not in ordered:
                need(VIEWS[name])
                ordered[name] = VIEWS[name]

    need(text)
    words = _names_in(text).union(*(_names_in(body) for body in ordered.values()))
    tables = duckdb_ctes([name for name in TABLES if name in words])
    listed = [*tables, *ordered.items()]
    if not listed:
        return text.strip()
    return "with " + ",\n".join(f"{name} as (\n{body}\n)" for name, body in listed) + "\n" + text.strip()


view(
    "day_params",
    "select date '2024-01-10' as today, 3 as today_idx, timestamp '2024-01-10 09:30:00' as now_at",
)

# ---- pings -------------------------------------------------------------------

view(
    "lift_pings",
    """
    select p.id, p.vehicle_id, p.longitude, p.latitude, p.tag, upper(rtrim(p.tag)) as tag_key, p.movement_time,
        p.imei, p.io9,
        coalesce(cast(v.contract_type_id as varchar), '00000000-0000-0000-0000-000000000000') as contract_type_id,
        coalesce(cast(v.company_id as varchar), '00000000-0000-0000-0000-000000000000') as company_id,
        coalesce(v.tenant_id, '00000000-0000-0000-0000-000000000000') as tenant_id
    from (
        select *, row_number() over (partition by upper(rtrim(tag)) order by movement_time, id) as place
        from pings
        where tag is not null and rtrim(tag) <> '-1' and trim(tag) <> '' and length(rtrim(tag)) <= 30
    ) p left join vehicles v on v.id = p.vehicle_id
    where place = 1
    """,
)
view(
    "sweep_pings",
    "select * from pings where tag is null or rtrim(tag) = '-1' or trim(tag) = ''",
)

# ---- sweeping ----------------------------------------------------------------

view(
    "street_pieces",
    """
    select id, x0 as ax, y0 as ay, xm - x0 as dx, ym - y0 as dy from streets where geo_type = 2
    union all select id, xm, ym, x1 - xm, y1 - ym from streets where geo_type = 2
    """,
)
view(
    "near_streets",
    """
    select p.id as ping_id, p.vehicle_id, p.movement_time, p.longitude, p.latitude,
        p.input1, p.input2, p.input3, p.input4, p.speed, p.ignition,
        t.id as trip_id, ts.id as trip_summary_id, ss.id as stop_summary_id, t.plan_id, pl.service_id,
        pl.contract_id, sv.group_id, sv.group_type, c.contract_type_id, v.company_id,
        vt.type as vehicle_type, co.type as company_type, pl.active_trips, pl.completion_pct as plan_old_pct,
        s.stop_order, s.street_length, s.street_weight, ss.total_distance,
        st.distance
    from sweep_pings p
    join vehicle_plans vp on vp.vehicle_id = p.vehicle_id
    join plans pl on pl.id = vp.plan_id
    join services sv on sv.id = pl.service_id
    join contracts c on c.id = sv.contract_id
    join contract_types ct on ct.id = c.contract_type_id
    join trips t on t.plan_id = pl.id and not t.is_deleted and t.status = 3
        and t.start_trip <= p.movement_time and t.end_trip > p.movement_time
    join vehicles v on v.id = p.vehicle_id
    join vehicle_types vt on vt.id = v.vehicle_type_id
    join companies co on co.id = v.company_id
    join trip_summaries ts on ts.trip_id = t.id
    join stops s on s.trip_id = t.id
    join stop_summaries ss on ss.stop_id = s.id
    join lateral (
        select min(sqrt(pow(p.longitude - ax - share * dx, 2) + pow(p.latitude - ay - share * dy, 2))) as distance
        from (select *, greatest(0, least(1, ((p.longitude - ax) * dx + (p.latitude - ay) * dy) / (dx * dx + dy * dy))) as share
            from street_pieces where street_pieces.id = s.geometry_id) along
    ) st on st.distance <= 0.0002e0
    """,
)
view(
    "sweep_segments",
    """
    select *, lag(longitude) over vehicle_order as last_longitude, lag(latitude) over vehicle_order as last_latitude
    from near_streets
    window vehicle_order as (partition by vehicle_id order by movement_time, stop_order, stop_summary_id, ping_id, trip_summary_id)
    """,
)
view(
    "sweep_metres",
    """
    select *, 2 * 6371000 * asin(least(1, sqrt(
        sin(radians(latitude - last_latitude) / 2) ** 2
        + cos(radians(latitude)) * cos(radians(last_latitude)) * sin(radians(longitude - last_longitude) / 2) ** 2
    ))) as metres
    from sweep_segments where last_latitude is not null
    """,
)
view(
    "sweep_flags",
    """
    select *,
        case vehicle_type
            when 16 then (company_type = 1 and input3 > 0) or (company_type = 3 and input2 + input3 > 0)
            when 24 then company_type in (1, 2, 3) and input1 > 0
            when 4 then company_type in (1, 2) and input3 > 0
            else false end as water_on,
        case vehicle_type
            when 16 then (company_type = 1 and input2 > 0) or (company_type = 3 and input1 + input4 > 0)
            when 24 then company_type in (1, 2, 3) and input2 > 0 and input4 > 0
            when 4 then company_type in (1, 2) and input2 > 0
            else false end as brush_on,
        speed >= 0.5 and speed <= 30 as gps_on,
        vehicle_type = 16 and company_type = 3
            and (least(input1, input2) > 0 or least(input3, input4) > 0) as side_on
    from sweep_metres
    """,
)
view(
    "sweep_legacy_flags",
    """
    select *,
        case vehicle_type
            when 1 then (company_type = 1 and input3 > 0) or (company_type = 2 and input2 > 0)
            when 2 then input1 > 0
            when 3 then company_type = 2 and input1 > 0
            when 16 then (company_type = 1 and input3 > 0) or (company_type = 3 and input2 + input3 > 0)
            else false end as water_on,
        case vehicle_type
            when 1 then company_type in (1, 3) and input2 > 0
            when 2 then input2 > 0
            when 3 then company_type = 2 and input2 > 0
            when 16 then (company_type in (1, 2) and input2 > 0) or (company_type = 3 and input1 + input4 > 0)
            else false end as brush_on,
        speed >= 1 and speed <= 29 and ignition as gps_on,
        vehicle_type = 16 and company_type = 3
            and (least(input1, input2) > 0 or least(input3, input4) > 0) as side_on
    from sweep_metres
    """,
)
view(
    "street_sums",
    """
    select trip_id, stop_summary_id, vehicle_type, company_type, stop_order, street_length, street_weight,
        total_distance,
        sum(case when gps_on and case when vehicle_type = 16 and company_type = 3 then side_on
            else water_on and brush_on end then metres else 0 end) as valid_metres,
        sum(case when water_on then metres else 0 end) as water_metres,
        sum(case when brush_on then metres else 0 end) as brush_metres,
        sum(case when gps_on then metres else 0 end) as gps_metres
    from sweep_flags group by all
    """,
)
view(
    "street_legacy_sums",
    """
    select trip_id, stop_summary_id, vehicle_type, company_type, stop_order, street_length, street_weight,
        total_distance,
        sum(case when gps_on and ((water_on and brush_on) or side_on) then metres else 0 end) as valid_metres,
        sum(case when water_on then metres else 0 end) as water_metres,
        sum(case when brush_on then metres else 0 end) as brush_metres,
        sum(case when gps_on then metres else 0 end) as gps_metres
    from sweep_legacy_flags group by all
    """,
)
COMPLETION = """
    select *, case when valid_metres > street_length then 100
        when street_length = 0 then 0
        else coalesce((total_distance + valid_metres) / street_length * 100, 0) end as completion
    from {}
"""
view("street_results", COMPLETION.format("street_sums"))
view("street_legacy_results", COMPLETION.format("street_legacy_sums"))
view(
    "street_winners",
    """
    select * from street_results
    qualify row_number() over (partition by stop_summary_id order by vehicle_type desc, company_type desc) = 1
    """,
)
view(
    "swept_summaries",
    """
    select ss.id, ss.stop_id, ss.total_distance + coalesce(w.valid_metres, 0) as total_distance,
        case when w.stop_summary_id is null then ss.completion_pct
            when w.completion = 0 then least(ss.completion_pct, 100) else least(w.completion, 100)
            end as completion_pct,
        case when coalesce(w.brush_metres, 0) = 0 then ss.brush_distance else w.brush_metres end as brush_distance,
        case when coalesce(w.water_metres, 0) = 0 then ss.water_distance else w.water_metres end as water_distance,
        case when coalesce(w.gps_metres, 0) = 0 then ss.gps_distance else w.gps_metres end as gps_distance,
        ss.is_swept or w.stop_summary_id is not null as is_swept
    from stop_summaries ss left join street_winners w on w.stop_summary_id = ss.id
    """,
)
view(
    "swept_trip_results",
    """
    select t.id as trip_id, ts.id as trip_summary_id, t.plan_id, pl.service_id, pl.contract_id, sv.group_id,
        pl.active_trips, pl.completion_pct as plan_old_pct,
        case when sum(s.street_weight) = 0 then 0
            else sum(ss.completion_pct * s.street_weight) / sum(s.street_weight) end as trip_pct,
        any_value(r.valid_metres) as valid_metres
    from (select trip_id, sum(valid_metres) as valid_metres from street_results group by trip_id) r
    join trips t on t.id = r.trip_id
    join trip_summaries ts on ts.trip_id = t.id
    join plans pl on pl.id = t.plan_id
    join services sv on sv.id = pl.service_id
    join stops s on s.trip_id = t.id
    join swept_summaries ss on ss.stop_id = s.id
    group by all
    """,
)
