"""Queries of the roll-up, the service log and the repair."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from curbflow.checks import sql_rollup  # noqa: F401
from curbflow.checks.registry import DIGITS, LOG_DAY, query, r_sql, rounded
from curbflow.plans import repair, rollup, service_log, sweeping
from curbflow.plans.batch import Batch

LOG_NOW = dt.datetime(2024, 1, 31, 0, 30)


@query("plan_average_lifting", f"select plan_id, {r_sql('plan_pct')} from lift_averages")
def plan_average_lifting(batch):
    return rollup.plan_average(batch.lift_contexts).select("plan_id", *rounded("plan_pct"))


@query("plan_average_sweeping", f"select plan_id, {r_sql('plan_pct')} from sweep_averages")
def plan_average_sweeping(batch):
    return rollup.plan_average(batch.swept).select("plan_id", *rounded("plan_pct"))


@query(
    "plan_completion_summary",
    f"select plan_id, service_id, contract_id, group_id, {r_sql('plan_pct')} from plan_results",
)
def plan_completion_summary(batch):
    return batch.levels["plan_pct"].select("plan_id", "service_id", "contract_id", "group_id", *rounded("plan_pct"))


@query("plan_completion_update", f"select id, {r_sql('completion_pct')} from new_plans")
def plan_completion_update(batch):
    return batch.levels["plans"].select("id", *rounded("completion_pct"))


@query("service_completion", f"select service_id, {r_sql('service_pct')} from service_results")
def service_completion(batch):
    return batch.levels["service_pct"].select("service_id", *rounded("service_pct"))


@query("service_completion_update", f"select id, {r_sql('completion_pct')} from new_services")
def service_completion_update(batch):
    return batch.levels["services"].select("id", *rounded("completion_pct"))


@query("group_completion", f"select contract_id, group_id, {r_sql('group_pct')} from group_results")
def group_completion(batch):
    return batch.levels["group_pct"].select("contract_id", "group_id", *rounded("group_pct"))


@query("group_completion_update", f"select contract_id, group_id, {r_sql('completion_pct')} from new_groups")
def group_completion_update(batch):
    return batch.levels["contract_groups"].select("contract_id", "group_id", *rounded("completion_pct"))


@query("contract_completion", f"select contract_id, {r_sql('contract_pct')} from contract_results")
def contract_completion(batch):
    return batch.levels["contract_pct"].select("contract_id", *rounded("contract_pct"))


@query(
    "contract_completion_update",
    f"""select c.id, round(coalesce(r.contract_pct, 0), {DIGITS}) as completion_pct
    from contracts c join contract_results r on r.contract_id = c.id""",
)
def contract_completion_update(batch):
    return batch.levels["contracts"].select("id", *rounded("completion_pct"))


FULL = f"""
    select level, id, round(pct, {DIGITS}) as pct from (
        select 'street' as level, stop_summary_id || '/' || vehicle_type || '/' || company_type as id,
            completion as pct from street_results
        union all
        select 'trip', cast(coalesce(s.trip_id, l.trip_id) as varchar),
            case when s.trip_id is not null then s.trip_pct when l.trip_pct > 100 then 100 else l.trip_pct end
        from swept_trip_results s full join lift_contexts l on l.trip_id = s.trip_id
        union all select 'plan', cast(plan_id as varchar), plan_pct from plan_results
        union all select 'service', cast(service_id as varchar), service_pct from service_results
        union all select 'group', contract_id || '/' || group_id, group_pct from group_results
        union all select 'contract', cast(contract_id as varchar), contract_pct from contract_results
    )
"""
@query("full_rollup", FULL)
def full_rollup(batch):
    return batch.all_levels().select("level", "id", *rounded("pct"))


# ---- service log -------------------------------------------------------------

LOG_COLUMNS = (
    "plan_id", "service_id", "contract_id", "group_id", "company_id", "created_date", "created_by", "modified_by",
    "modified_date", "group_type", "contract_type_id", "contract_type",
)
LOG_PCT = ("plan_pct", "service_pct", "group_pct", "contract_pct")


@query(
    "service_log_seed",
    """select g.contract_id, g.group_id, c.company_id, date '2024-01-30' as created_date, 0 as group_type,
        ct.id as contract_type_id, 0 as contract_type, 0 as service_pct, 0 as group_pct, 0 as contract_pct
    from contract_groups g join contracts c on c.id = g.contract_id
    join services s on s.contract_id = g.contract_id and s.group_id = g.group_id
    join contract_types ct on ct.id = c.contract_type_id
    where not exists (select 1 from service_log l where l.contract_id = g.contract_id and l.group_id = g.group_id
        and l.created_date = date '2024-01-30' and cast(l.logged_at as date) = date '2024-01-30')""",
)
def service_log_seed(batch):
    rows = service_log.seed_rows(batch.fleet.service_log, batch.fleet, LOG_DAY, LOG_NOW)
    types = ("group_type", "contract_type_id", "contract_type")
    percentages = (F.col(name).cast("int").alias(name) for name in LOG_PCT[1:])
    return rows.select("contract_id", "group_id", "company_id", "created_date", *types, *percentages)


def _merged_log(batch) -> DataFrame:
    rows = service_log.plan_rows(batch.lift_contexts, sweeping.seen_plans(batch.totals, batch.fleet))
    return service_log.upsert(batch.fleet.service_log, rows, LOG_DAY, LOG_NOW)


@query("service_log_upsert", f"select {', '.join(LOG_COLUMNS)} from log_merged")
def service_log_upsert(batch):
    return _merged_log(batch).select(*LOG_COLUMNS)


@query(
    "service_log_percentages",
    f"""select {', '.join('m.' + name for name in LOG_COLUMNS)},
        {r_sql(*LOG_PCT)}
    from (
        select m.* exclude (plan_pct, service_pct, group_pct, contract_pct),
            case when m.created_date = date '2024-01-30' and p.plan_id is not null then coalesce(p.plan_pct, 0)
                else m.plan_pct end as plan_pct,
            case when m.created_date = date '2024-01-30' and s.service_id is not null then coalesce(s.service_pct, 0)
                else m.service_pct end as service_pct,
            case when m.created_date = date '2024-01-30' and g.group_id is not null then coalesce(g.group_pct, 0)
                else m.group_pct end as group_pct,
            case when m.created_date = date '2024-01-30' and c.contract_id is not null
                then coalesce(c.contract_pct, 0) else m.contract_pct end as contract_pct
        from log_merged m left join plan_results p on p.plan_id = m.plan_id
        left join service_results s on s.service_id = m.service_id
        left join group_results g on g.contract_id = m.contract_id and g.group_id = m.group_id
        left join contract_results c on c.contract_id = m.contract_id
    ) m""",
)
def service_log_percentages(batch):
    filled = rollup.log_percentages(_merged_log(batch), batch.levels, LOG_DAY)
    return filled.select(*LOG_COLUMNS, *rounded(*LOG_PCT))


# ---- a whole batch -----------------------------------------------------------


def count_sql(table: str, source: str) -> str:
    return f"select '{table}' as table_name, count(*) as changed from ({source})"


BATCH_COUNTS = " union all ".join(
    count_sql(table, source)
    for table, source in {
        "tag_references": "select 1 from lift_pings where tag_key not in (select upper(rtrim(tag)) from tag_references)",
        "bins": "select 1 from bins where upper(rtrim(tag)) in (select tag_key from lift_matches)",
        "streets": "select 1 from streets where upper(rtrim(tag)) in (select tag_key from lift_matches where case_no = 1)",
        "stops": "select 1 from added_stops",
        "stop_summaries": """select summary_id from lift_matches where summary_id is not null
            union select stop_summary_id from street_results
            union all select 1 from added_stops""",
        "trip_summaries": """select trip_summary_id from lift_contexts
            union select trip_summary_id from swept_trip_results""",
        "latest_tag_events": """select 1 from lift_matches m
            join bins b on upper(rtrim(b.tag)) = m.tag_key and not b.is_deleted
            join vehicles v on v.id = m.vehicle_id and not v.is_deleted where m.case_no = 7""",
        "outside_scope_events": """select 1 from lift_matches m join bins b on upper(rtrim(b.tag)) = m.tag_key
            join vehicles v on v.id = m.vehicle_id join contract_types t on t.id = v.contract_type_id
            where m.case_no in (3, 4)""",
        "tag_violations": "select 1 from new_violations",
        "plans": "select 1 from plan_results",
        "services": "select 1 from service_results",
        "contract_groups": "select 1 from contract_groups",
        "contracts": "select 1 from contracts",
        "service_log": """select 1 from log_merged where created_date = date '2024-01-30'
            union all
            select 1 from contract_groups g
            join services s on s.contract_id = g.contract_id and s.group_id = g.group_id
            where not exists (select 1 from service_log l where l.contract_id = g.contract_id
                and l.group_id = g.group_id and l.created_date = date '2024-01-30'
                and cast(l.logged_at as date) = date '2024-01-30')""",
    }.items()
)


@query("ping_batch_consume", BATCH_COUNTS)
def ping_batch_consume(batch):
    """Rows every table takes from the batch. Writing them once is tested on the stream."""
    changes = Batch(batch.fleet, now=dt.datetime.combine(LOG_DAY, dt.time(23, 30))).changes()
    counts = [
        rows.agg(F.count(F.lit(1)).alias("changed")).select(F.lit(table).alias("table_name"), "changed")
        for table, rows in changes.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# ---- repair ------------------------------------------------------------------


@query("fix_expected", "select trip_id, expected from expected_fixes")
def fix_expected(batch):
    return repair.fix_expected(batch.fleet)


@query("fix_actual", "select trip_id, actual from actual_fixes")
def fix_actual(batch):
    return repair.fix_actual(batch.fleet)


@query(
    "fix_percentage",
    """select id, cast(expected as double) as expected_coverage, actual as actual_coverage,
        case when not is_bin_trip then completion_pct when actual * 100 > 100 * expected and expected <> 0 then 100
            else round(actual * 100 / nullif(expected, 0), 2) end as completion_pct
    from (
        select ts.id, ts.completion_pct, coalesce(e.expected, ts.expected_coverage) as expected,
            coalesce(cast(a.actual as double), ts.actual_coverage) as actual,
            ts.trip_id in (select trip_id from bin_service_trips) as is_bin_trip
        from trip_summaries ts left join expected_fixes e on e.trip_id = ts.trip_id
        left join actual_fixes a on a.trip_id = ts.trip_id)""",
)
def fix_percentage(batch):
    return repair.fix_percentage(batch.fleet).select(
        "id", F.col("expected_coverage").cast("double").alias("expected_coverage"), "actual_coverage", "completion_pct"
    )
