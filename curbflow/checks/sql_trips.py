"""SQL twins of trip creation, for Wednesday 2024-01-10, 09:30."""

from __future__ import annotations

from curbflow.checks.sql_views import view

view(
    "due_plans",
    """
    select p.* from plans p join contract_details c on c.service_id = p.service_id
    where not p.is_deleted and cast(p.created_date as date) <= date '2024-01-10'
        and (p.is_monthly or p.id in (
            select plan_id from plan_days d join weekdays w on w.id = d.weekday_id where w.day = 3))
        and ((p.is_monthly and p.monthly_days is not null) or p.id in (select plan_id from plan_days))
        and p.id in (select plan_id from plan_details)
    """,
)
view(
    "weekly_plan_starts",
    """
    select p.id as plan_id,
        date '2024-01-10' + cast(o.ahead as int) + cast(p.start_date as time) as start_trip
    from due_plans p join (
        select d.plan_id, (w.day + 4) % 7 as ahead
        from plan_days d join weekdays w on w.id = d.weekday_id
        where not d.is_deleted
        qualify row_number() over (partition by d.plan_id order by (w.day + 4) % 7) <= 2
    ) o on o.plan_id = p.id
    where not p.is_monthly and (o.ahead > 0 or cast(p.start_date as time) >= time '09:30:00')
    """,
)
view(
    "monthly_plan_starts",
    """
    select plan_id, make_date(2024, 1, day_no) + cast(start_date as time) as start_trip
    from (
        select id as plan_id, start_date, cast(unnest(string_split(monthly_days, ',')) as int) as day_no
        from due_plans where is_monthly
    ) where day_no >= 10
    """,
)
view(
    "plan_starts",
    "select * from weekly_plan_starts union all select * from monthly_plan_starts",
)
view(
    "wanted_starts",
    """
    select * from plan_starts s where not exists (
        select 1 from trips t where t.plan_id = s.plan_id and t.start_trip = s.start_trip and not t.is_deleted)
    """,
)
view(
    "made_trips",
    """
    select *, 'TRI-' || year(start_trip) || month(start_trip) || '-' || number as reference_code from (
        select s.plan_id, s.start_trip,
            cast(s.start_trip as date) + case when p.end_date::time < p.start_date::time then 1 else 0 end
                + p.end_date::time as end_trip,
            d.driver_id, v.vehicle_id,
            (select count(*) from trips) + row_number() over (
                order by s.plan_id, s.start_trip, d.driver_id nulls first, v.vehicle_id nulls first) as number
        from wanted_starts s join due_plans p on p.id = s.plan_id
        left join driver_plans d on d.plan_id = p.id and d.is_main and not d.is_deleted
        left join vehicle_plans v on v.plan_id = p.id and v.is_main and not v.is_deleted
    )
    """,
)
view(
    "made_stops",
    """
    select t.reference_code as trip_code, x.tag, x.bin_id, x.stop_order, x.street_weight,
        case when x.length > 0 then x.length * greatest(c.repetitions, 1) else 0 end as street_length,
        g.id as geometry_id, g.reference_code
    from due_plans p join made_trips t on t.plan_id = p.id join plan_details x on x.plan_id = p.id
    join contract_details c on c.service_id = p.service_id left join streets g on g.id = x.geometry_id
    """,
)
