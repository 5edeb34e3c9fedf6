"""Fleet tables derived from the ``events`` table.

Each table is one SELECT that Spark and DuckDB both run, so the oracle starts
from the same rows. Only plain arithmetic, CASE and casts are used. Names in
braces are other tables, or one of the engine words in ``SPARK_WORDS`` /
``DUCKDB_WORDS``. Nothing here is fixed in size except the seven weekdays, the
four vehicle types and the three companies: all else grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbflow.session import cut_lineage

SPARK_WORDS = {
    "ts": "timestamp_ntz",
    "each_day": "explode(sequence(1L, 30L))",
    "each_weekday": "explode(sequence(0L, 6L))",
    "each_of_3": "explode(sequence(1L, 3L))",
    "each_of_4": "explode(sequence(0L, 3L))",
}
DUCKDB_WORDS = {
    "ts": "timestamp",
    "each_day": "unnest(range(1, 31))",
    "each_weekday": "unnest(range(0, 7))",
    "each_of_3": "unnest(range(1, 4))",
    "each_of_4": "unnest(range(0, 4))",
}

TABLES = {
    "pings": """
        select event_id as id, user_id as vehicle_id,
            39.2e0 + (user_id % 10) * 0.01e0 + (event_id % 50) * 0.0001e0 as longitude,
            21.4e0 + (user_id % 7) * 0.01e0 + (event_id % 3) * 0.00015e0 as latitude,
            case when event_type in ('purchase', 'signup') then
                    case when event_id % 97 = 0
                            then concat('TAG-OVERLONG-000000000000000000-', cast(event_id as string))
                        when event_id % 23 = 0 then concat('tag', cast(event_id as string), '  ')
                        else concat('TAG', cast(event_id - case when event_id % 5 = 4 then 1 else 0 end as string))
                    end
                when event_type = 'error' then case when event_id % 7 = 0 then '   ' else '-1' end
            end as tag,
            ts as movement_time,
            case when event_id % 19 = 0 then concat('IMEI-', cast(user_id as string))
                else cast(860000000000000 + user_id as string) end as imei,
            event_id % 2 as input1, event_id % 3 as input2, event_id % 5 as input3, event_id % 7 as input4,
            event_id % 35 as speed, event_id % 10 <> 0 as ignition,
            case when event_id % 13 = 0 then null else value / 100 end as io9
        from {events}""",
    "users": "select distinct user_id from {events}",
    "vehicle_days": """
        select user_id, {each_day} as day_no from {users} where user_id % 5 <> 4""",
    "trips": """
        select user_id * 100 + day_no as id, user_id as plan_id, user_id as vehicle_id,
            cast('2023-12-31 06:00:00' as {ts}) + day_no * interval '1' day as start_trip,
            cast('2023-12-31 18:00:00' as {ts}) + day_no * interval '1' day as end_trip,
            case when (user_id * 100 + day_no) % 50 = 7 then 1 else 3 end as status,
            (user_id * 100 + day_no) % 40 = 39 as is_deleted, cast(null as bigint) as driver_id,
            cast(cast('2023-12-31 06:00:00' as {ts}) + day_no * interval '1' day as date) as trip_date,
            cast(null as string) as reference_code, cast('2023-12-30 00:00:00' as {ts}) as created_date
        from {vehicle_days}
        union all
        select user_id * 100 + 50 + day_no as id, user_id as plan_id, user_id as vehicle_id,
            cast('2023-12-31 14:00:00' as {ts}) + day_no * interval '1' day as start_trip,
            cast('2023-12-31 22:00:00' as {ts}) + day_no * interval '1' day as end_trip,
            3 as status, day_no % 9 = 0 as is_deleted, cast(null as bigint) as driver_id,
            cast(cast('2023-12-31 14:00:00' as {ts}) + day_no * interval '1' day as date) as trip_date,
            cast(null as string) as reference_code, cast('2023-12-30 00:00:00' as {ts}) as created_date
        from {vehicle_days} where user_id % 6 = 0""",
    "stops": """
        select event_id as id, concat('TAG', cast(event_id as string)) as tag,
            (case when event_id % 3 = 0 then user_id else user_id - user_id % 5 end) * 100 + day(ts) as trip_id,
            event_id as bin_id, event_id % 12 as stop_order,
            case when event_id % 10 = 0 then null else 0e0 end as street_weight, 0e0 as street_length,
            cast(null as bigint) as geometry_id, event_id % 53 = 0 as is_deleted
        from {events} where event_id % 3 <> 2 and (event_id % 3 = 1 or user_id % 5 <> 4)
        union all
        select -id as id, cast(null as string) as tag, id as trip_id, cast(null as bigint) as bin_id,
            1 as stop_order, cast(1 + vehicle_id % 5 as double) as street_weight, 520e0 as street_length,
            1000000000000 + vehicle_id as geometry_id, false as is_deleted
        from {trips}""",
    "stop_summaries": """
        select id * 10 + 1 as id, id as stop_id,
            case when id % 4 = 0 then 2 else 1 end as bin_status,
            case id % 8 when 0 then 13 when 2 then 14 when 4 then 13 when 5 then 15 when 6 then 16 when 7 then 13
                end as status_lookup,
            case when id % 4 = 0 then cast('2024-01-01 00:00:20' as {ts}) + (id % 43200) * interval '1' minute
                end as last_completion,
            case when id % 4 = 0 then 1 + id % 3 else 0 end as lifts,
            case when id < 0 then cast(-id % 60 as double) else 0e0 end as completion_pct,
            case when id < 0 then cast(-id % 300 as double) else 0e0 end as total_distance,
            case when id < 0 then 11e0 else 0e0 end as brush_distance,
            case when id < 0 then 12e0 else 0e0 end as water_distance,
            case when id < 0 then 13e0 else 0e0 end as gps_distance,
            id % 6 = 0 as is_swept, 1 + id % 2 as completion_type,
            cast(null as {ts}) as completion_time, 0e0 as bin_longitude, 0e0 as bin_latitude,
            cast(null as bigint) as vehicle_id, cast(null as bigint) as device
        from {stops} where id % 17 <> 5""",
    "trip_summaries": """
        select id * 10 + 2 as id, id as trip_id,
            case when id % 37 = 0 then 0 else 2 + id % 5 end as expected_coverage,
            cast(id % 7 as double) as actual_coverage, cast(id % 90 as double) as completion_pct,
            case when id % 3 = 0 then start_trip + interval '10' minute end as actual_start,
            case when id % 11 = 0 then null else (id % 100) * 1.5e0 end as waste_weight, 5 as status
        from {trips}
        union all
        select id * 10 + 7 as id, id as trip_id, 3 + id % 4 as expected_coverage, cast(id % 5 as double) as actual_coverage,
            0e0 as completion_pct, cast(null as {ts}) as actual_start, 2e0 as waste_weight, 5 as status
        from {trips} where id % 13 = 4""",
    "plans": """
        select user_id as id, user_id % 20 as service_id, user_id % 20 % 5 % 2 as contract_id,
            case when user_id % 9 = 0 then cast('2023-11-05 22:00:00' as {ts})
                else cast('2023-11-05 06:00:00' as {ts}) end as start_date,
            case when user_id % 9 = 0 then cast('2023-11-06 04:00:00' as {ts})
                else cast('2023-11-05 18:00:00' as {ts}) end as end_date,
            user_id % 4 = 0 as is_monthly,
            case when user_id % 4 = 0 and user_id % 24 <> 0 then '1,10,20,28' end as monthly_days,
            cast('2023-12-01 08:00:00' as {ts}) + (user_id % 60) * interval '1' day as created_date,
            user_id % 27 = 26 as is_deleted, user_id % 6 as active_trips,
            cast(user_id % 50 as double) as completion_pct, 4 + user_id % 5 as expected_coverage
        from {users}""",
    "weekdays": """
        select day_idx + 1 as id, day_idx as day, concat('Day-', cast(day_idx as string)) as name
        from (select {each_weekday} as day_idx) d""",
    "plan_days": """
        select id as plan_id, 1 + id % 7 as weekday_id, id % 29 = 0 as is_deleted from {plans} where not is_monthly
        union all
        select id as plan_id, 1 + (id + 3) % 7 as weekday_id, false as is_deleted from {plans} where not is_monthly
        union all
        select id as plan_id, 1 + (id + 5) % 7 as weekday_id, false as is_deleted
        from {plans} where not is_monthly and id % 3 = 1""",
    "plan_details": """
        select event_id * 2 as id, user_id as plan_id, concat('TAG', cast(event_id as string)) as tag,
            event_id as bin_id, event_id % 12 as stop_order, cast(event_id % 4 as double) * 100 as length,
            cast(event_id % 5 as double) as street_weight,
            case when event_id % 6 = 0 then event_id end as geometry_id
        from {events} where event_id % 3 = 0 and user_id % 16 <> 15
        union all
        select event_id * 2 + 1 as id, user_id as plan_id, concat('TAG', cast(event_id as string)) as tag,
            event_id as bin_id, 20 as stop_order, 50e0 as length, 1e0 as street_weight, cast(null as bigint) as geometry_id
        from {events} where event_id % 21 = 0 and user_id % 16 <> 15""",
    "contract_details": """
        select id as service_id, id % 4 as repetitions from {services}
        union all
        select id as service_id, 2 as repetitions from {services} where id % 7 = 2""",
    "driver_plans": """
        select id as plan_id, id * 10 + 1 as driver_id, id % 8 <> 3 as is_main, id % 15 = 2 as is_deleted from {plans}
        union all
        select id as plan_id, id * 10 + 2 as driver_id, false as is_main, false as is_deleted from {plans}""",
    "vehicle_plans": """
        select id as plan_id, id as vehicle_id, true as is_main, id % 14 = 3 as is_deleted from {plans}
        union all
        select id as plan_id, id + 1 as vehicle_id, false as is_main, false as is_deleted
        from {plans} where id % 7 = 0""",
    "crew_plans": """
        select id as plan_id, id * 10 + 1 as crew_id from {plans}
        union all
        select id as plan_id, id * 10 + 2 as crew_id from {plans} where id % 3 = 0""",
    "crew_trips": """
        select id as trip_id, plan_id * 10 + 1 as crew_id, id % 6 = 0 as is_deleted from {trips} where id % 2 = 0""",
    "plan_texts": """
        select id as plan_id, 'en' as locale, concat('Plan ', cast(id as string)) as description from {plans}
        union all
        select id as plan_id, 'ar' as locale, cast(null as string) as description from {plans} where id % 4 = 1""",
    "services": """
        select distinct user_id % 20 as id, user_id % 20 % 5 as group_id, user_id % 20 % 5 % 2 as contract_id,
            cast(1 + user_id % 20 % 4 as double) as weight_in_group,
            case when user_id % 20 = 7 then null else cast(user_id % 20 * 3 as double) end as completion_pct,
            user_id % 20 = 19 as is_deleted, user_id % 20 % 3 as group_type, user_id % 20 % 6 as kind_id
        from {users}""",
    "service_geometry": """
        select distinct kind_id, case when kind_id % 2 = 0 then 1 else 2 end as geometry_type from {services}""",
    "contract_groups": """
        select distinct contract_id, group_id, cast(1 + group_id % 4 as double) as weight_in_contract,
            cast(group_id * 10 as double) as completion_pct from {services}""",
    "service_groups": "select distinct group_id as id from {services}",
    "contracts": """
        select distinct contract_id as id, contract_id % 3 as contract_type_id, contract_id + 1 as company_id,
            cast(contract_id * 5 as double) as completion_pct from {services}""",
    "contract_types": """
        select type_no - 1 as id, concat('Type ', cast(type_no as string)) as name
        from (select {each_of_3} as type_no) d""",
    "companies": "select company_no as id, company_no as type from (select {each_of_3} as company_no) d",
    "vehicles": """
        select user_id as id, concat('PLATE-', cast(user_id as string)) as plate, user_id % 4 as vehicle_type_id,
            case when user_id % 17 = 16 then null else user_id % 3 end as contract_type_id,
            user_id % 3 + 1 as company_id, concat('TENANT-', cast(user_id % 2 as string)) as tenant_id,
            user_id % 31 = 30 as is_deleted
        from {users} where user_id % 25 <> 24""",
    "vehicle_types": """
        select type_no as id, case type_no when 1 then 24 when 2 then 4 else 16 end as type,
            1000e0 as empty_weight, 9000e0 as full_weight,
            0.5e0 as empty_voltage, case when type_no = 3 then 0.5e0 else 4.5e0 end as full_voltage
        from (select {each_of_4} as type_no) d""",
    "bins": """
        select event_id as id, concat('TAG', cast(event_id as string)) as tag,
            39.2e0 + (user_id % 10) * 0.01e0 + (event_id % 50) * 0.0001e0 as longitude,
            21.4e0 + (user_id % 7) * 0.01e0 + (event_id % 3) * 0.00015e0 as latitude,
            event_id % 3 as contract_type_id, event_id % 3 + 1 as company_id, event_id % 41 = 0 as is_deleted,
            cast('2023-10-01 00:00:00' as {ts}) + (event_id % 90) * interval '1' hour as created_date,
            case when event_id % 2 = 0 then cast('2023-12-01 00:00:00' as {ts}) + (event_id % 90) * interval '1' hour
                end as modified_date,
            case when event_id % 4 = 0 then ts - interval '2' hour end as last_completion,
            cast(null as string) as modified_by
        from {events}
        union all
        select -event_id - 1 as id, concat('TAG', cast(event_id as string)) as tag, 39.2e0 as longitude,
            21.4e0 as latitude, (event_id + 1) % 3 as contract_type_id, event_id % 3 + 1 as company_id,
            false as is_deleted, cast('2023-10-02 00:00:00' as {ts}) as created_date,
            case when event_id % 38 = 0 then cast('2023-12-02 00:00:00' as {ts}) end as modified_date,
            cast(null as {ts}) as last_completion, cast(null as string) as modified_by
        from {events} where event_id % 19 = 0""",
    "streets": """
        select 1000000000000 + user_id as id, cast(null as string) as tag, 2 as geo_type,
            concat('ST-', cast(user_id as string)) as reference_code,
            39.2e0 + (user_id % 10) * 0.01e0 as x0, 21.4e0 + (user_id % 7) * 0.01e0 as y0,
            39.2e0 + (user_id % 10) * 0.01e0 + 0.0025e0 as xm,
            21.4e0 + (user_id % 7) * 0.01e0 + case user_id % 6 when 1 then 0.0003e0 when 2 then 0.0015e0 else 0e0 end as ym,
            39.2e0 + (user_id % 10) * 0.01e0 + 0.005e0 as x1,
            21.4e0 + (user_id % 7) * 0.01e0 + case user_id % 6 when 1 then 0.0006e0 else 0e0 end as y1,
            cast(null as double) as longitude, cast(null as double) as latitude, false as is_deleted,
            cast('2023-10-01 00:00:00' as {ts}) as created_date, cast(null as {ts}) as modified_date,
            cast(null as string) as modified_by
        from {users} where user_id % 5 <> 4
        union all
        select event_id as id, concat('TAG', cast(event_id as string)) as tag, 1 as geo_type,
            concat('BN-', cast(event_id as string)) as reference_code,
            cast(null as double) as x0, cast(null as double) as y0, cast(null as double) as xm, cast(null as double) as ym,
            cast(null as double) as x1, cast(null as double) as y1,
            39.2e0 as longitude, 21.4e0 as latitude, event_id % 43 = 0 as is_deleted,
            cast('2023-10-01 00:00:00' as {ts}) + (event_id % 9) * interval '1' hour as created_date,
            cast(null as {ts}) as modified_date, cast(null as string) as modified_by
        from {events} where event_id % 6 in (0, 2)""",
    "tag_references": """
        select concat('TAG', cast(event_id as string)) as tag,
            39.2e0 + (user_id % 10) * 0.01e0 + (event_id % 50) * 0.0001e0 as longitude,
            21.4e0 + (user_id % 7) * 0.01e0 + (event_id % 3) * 0.00015e0
                + case when event_id % 11 = 0 then 0.0001e0 else 0e0 end as latitude
        from {events} where event_id % 7 <> 3""",
    "tag_violations": """
        select concat('TAG', cast(event_id as string)) as tag, event_id as bin_id, cast(null as bigint) as vehicle_id,
            cast(null as {ts}) as movement_time, cast(null as double) as metres
        from {events} where event_id % 33 = 0""",
    "service_log": """
        select id * 10 as id, id as plan_id, service_id, contract_id, service_id % 5 as group_id,
            contract_id + 1 as company_id, cast('2024-01-30' as date) as created_date, cast('2024-01-30 01:00:00' as {ts}) as logged_at,
            'seed' as created_by, cast(null as string) as modified_by, cast(null as {ts}) as modified_date,
            cast(null as int) as group_type, cast(null as bigint) as contract_type_id, 0 as contract_type,
            cast(null as double) as plan_pct, cast(null as double) as service_pct, 0e0 as group_pct, 0e0 as contract_pct
        from {plans} where id % 6 = 0 and id % 5 in (0, 2)
        union all
        select -1 - contract_id * 100 - group_id as id, cast(null as bigint) as plan_id,
            cast(null as bigint) as service_id, contract_id, group_id, contract_id + 1 as company_id, cast('2024-01-30' as date) as created_date,
            case when group_id % 4 = 0 then cast('2024-01-29 01:00:00' as {ts})
                else cast('2024-01-30 01:00:00' as {ts}) end as logged_at, 'seed' as created_by,
            cast(null as string) as modified_by, cast(null as {ts}) as modified_date,
            cast(null as int) as group_type, cast(null as bigint) as contract_type_id, 0 as contract_type, cast(null as double) as plan_pct, 0e0 as service_pct,
            0e0 as group_pct, 0e0 as contract_pct
        from {contract_groups} where group_id % 2 = 0
        union all
        select id * 10 + 1 as id, id as plan_id, service_id, contract_id, service_id % 5 as group_id,
            contract_id + 1 as company_id, cast('2024-01-29' as date) as created_date, cast('2024-01-29 01:00:00' as {ts}) as logged_at,
            'seed' as created_by, cast(null as string) as modified_by, cast(null as {ts}) as modified_date,
            cast(null as int) as group_type, cast(null as bigint) as contract_type_id, 0 as contract_type,
            7e0 as plan_pct, 8e0 as service_pct, 9e0 as group_pct, 10e0 as contract_pct
        from {plans} where id % 4 = 0""",
}


# Taken from the events once, as most other tables start from it.
SETTLED = {"users"}


def references_of(text: str) -> list[str]:
    return [name for name in TABLES if "{" + name + "}" in text]


class DerivedFleet:
    """Fleet tables over ``events``, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._built: dict[str, DataFrame] = {"events": spark.read.parquet(f"{folder}/events.parquet")}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        text = TABLES[name]
        needed = {ref: getattr(self, ref) for ref in references_of(text)}
        if "{events}" in text:
            needed["events"] = self.events
        for word, meaning in SPARK_WORDS.items():
            text = text.replace("{" + word + "}", meaning)
        built = self._spark.sql(text, **needed)
        if name in SETTLED:
            return cut_lineage(built)
        return with_lines(built) if name == "streets" else built


def with_lines(streets: DataFrame) -> DataFrame:
    """Street geometry as an array of points: both ends and one between, which lies beside the straight line for some."""
    ends = ("0", "m", "1")
    line = F.array(*(F.struct(F.col(f"x{end}").alias("lon"), F.col(f"y{end}").alias("lat")) for end in ends))
    return streets.withColumn("line", F.when(F.col("geo_type") == 2, line)).drop(*(f"{axis}{end}" for axis in "xy" for end in ends))


def duckdb_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, SELECT) of the tables and all they need, in order, for DuckDB."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        text = TABLES[name]
        for ref in references_of(text):
            add(ref)
        for word, meaning in DUCKDB_WORDS.items():
            text = text.replace("{" + word + "}", meaning)
        for ref in [*TABLES, "events"]:
            text = text.replace("{" + ref + "}", ref)
        done[name] = text.strip()

    for name in names:
        add(name)
    return list(done.items())
