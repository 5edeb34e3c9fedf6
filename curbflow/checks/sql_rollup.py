"""SQL twins of the roll-up, the service log and the repair."""

from __future__ import annotations

from curbflow.checks.sql_views import view

AVERAGE = """
    select plan_id, (plan_old_pct * active_trips + {mean} * count(*)) / nullif(active_trips + count(*), 0) as plan_pct
    from {trips} group by plan_id, plan_old_pct, active_trips
"""
view("lift_averages", AVERAGE.format(mean="round(avg(trip_pct), 6)", trips="lift_contexts"))
view("sweep_averages", AVERAGE.format(mean="avg(trip_pct)", trips="swept_trip_results"))
view(
    "plan_results",
    """
    select distinct a.plan_id, a.plan_pct, p.service_id, p.contract_id, s.group_id
    from (
        select * from lift_averages
        union all
        select * from sweep_averages where plan_id not in (select plan_id from lift_averages)
    ) a join plans p on p.id = a.plan_id join services s on s.id = p.service_id
    """,
)
view(
    "new_plans",
    """
    select p.* exclude (completion_pct),
        case when r.plan_id is null then p.completion_pct else r.plan_pct end as completion_pct
    from plans p left join plan_results r on r.plan_id = p.id
    """,
)
view(
    "service_results",
    """
    select service_id, avg(completion_pct) as service_pct from new_plans
    where service_id in (select service_id from plan_results) group by service_id
    """,
)
view(
    "new_services",
    """
    select s.* exclude (completion_pct),
        case when r.service_id is null then s.completion_pct else r.service_pct end as completion_pct
    from services s left join service_results r on r.service_id = s.id
    """,
)
view(
    "group_results",
    """
    select g.contract_id, g.group_id,
        sum(s.completion_pct * s.weight_in_group) / nullif(sum(s.weight_in_group), 0) as group_pct
    from contract_groups g join new_services s on s.contract_id = g.contract_id and s.group_id = g.group_id
    group by g.contract_id, g.group_id
    """,
)
view(
    "new_groups",
    """
    select g.contract_id, g.group_id, g.weight_in_contract,
        case when r.group_id is null then g.completion_pct else coalesce(r.group_pct, 0) end as completion_pct
    from contract_groups g left join group_results r on r.contract_id = g.contract_id and r.group_id = g.group_id
    """,
)
view(
    "contract_results",
    """
    select contract_id, sum(completion_pct / 100 * weight_in_contract) / nullif(sum(weight_in_contract), 0) * 100
        as contract_pct
    from new_groups group by contract_id
    """,
)

# ---- log ---------------------------------------------------------------------

view(
    "log_sources",
    """
    select plan_id, service_id, contract_id, group_id, company_id, group_type, contract_type_id, min(seen_by) as seen_by
    from (
        select distinct plan_id, service_id, contract_id, group_id, company_id, group_type, contract_type_id,
            'lifting' as seen_by from lift_contexts
        union all
        select plan_id, service_id, contract_id, group_id, company_id, group_type, contract_type_id,
            'sweeping' as seen_by from near_streets
        qualify row_number() over (partition by plan_id
            order by service_id, contract_id, group_id, company_id) = 1
    ) group by all
    """,
)
view(
    "log_merged",
    """
    select l.plan_id, l.service_id, l.contract_id, l.group_id, l.company_id, l.created_date, l.created_by,
        coalesce(s.seen_by, l.modified_by) as modified_by,
        case when s.seen_by is null then l.modified_date else timestamp '2024-01-31 00:30:00' end as modified_date,
        l.group_type, l.contract_type_id, l.contract_type, l.plan_pct, l.service_pct, l.group_pct, l.contract_pct
    from service_log l left join log_sources s on s.plan_id = l.plan_id and s.service_id = l.service_id
        and s.contract_id = l.contract_id and s.group_id = l.group_id and s.company_id = l.company_id
        and l.created_date = date '2024-01-30'
    union all
    select s.plan_id, s.service_id, s.contract_id, s.group_id, s.company_id, date '2024-01-30', s.seen_by, null,
        null, s.group_type, s.contract_type_id, 0, null, null, null, null
    from log_sources s where not exists (
        select 1 from service_log l where s.plan_id = l.plan_id and s.service_id = l.service_id
            and s.contract_id = l.contract_id and s.group_id = l.group_id and s.company_id = l.company_id
            and l.created_date = date '2024-01-30')
    """,
)

# ---- repair ------------------------------------------------------------------

view(
    "bin_service_trips",
    """
    select t.id as trip_id from trips t join plans p on p.id = t.plan_id
    where p.service_id in (
        select s.id from services s join service_geometry g on g.kind_id = s.kind_id where g.geometry_type = 1)
    """,
)
view(
    "expected_fixes",
    """
    with planned as (
        select trip_id, sum(own) as rows_planned from (
            select s.trip_id, s.id, count(*) as own from stops s join stop_summaries ss on ss.stop_id = s.id
            group by s.trip_id, s.id having count(*) filter (where ss.status_lookup in (15, 16)) = 0) per_stop
        group by trip_id),
    said as (
        select trip_id, expected_coverage, count(*) as said_by, bool_or(expected_coverage = actual_coverage) as complete
        from trip_summaries group by trip_id, expected_coverage)
    select said.trip_id, cast(max(rows_planned * said_by) as bigint) as expected
    from said join planned on planned.trip_id = said.trip_id
    where rows_planned * said_by <> expected_coverage and said.trip_id in (select trip_id from said where complete)
        and said.trip_id in (select trip_id from bin_service_trips)
    group by said.trip_id
    """,
)
view(
    "actual_fixes",
    """
    with lifted as (
        select s.trip_id, sum(case when ss.bin_status = 2 and s.stop_order > 0
            and (ss.status_lookup = 13 or ss.completion_type = 2) then 1 else 0 end) as stops_lifted
        from stop_summaries ss join stops s on s.id = ss.stop_id group by s.trip_id),
    rows_of as (select trip_id, count(*) as n from trip_summaries group by trip_id)
    select trip_id, cast(stops_lifted * n as bigint) as actual from lifted join rows_of using (trip_id)
    where trip_id in (select trip_id from bin_service_trips)
    """,
)
