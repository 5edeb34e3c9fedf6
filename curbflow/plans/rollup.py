"""Completion from trip to plan, service, service group and contract.

Each level is one grouping that Spark reduces on the map side first, so a plan
or contract that owns a large part of the trips costs no more than any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from curbflow.functions.numeric import ratio, weighted_mean
from curbflow.functions.time import date_lit
from curbflow.operators import first_per

LIFTING, SWEEPING = 0, 1


def plan_average(trips: DataFrame) -> DataFrame:
    """(old average x active trips + mean of the new trips x their number) / all of them, per plan.

    ``trips`` has plan_id, trip_id, trip_pct, active_trips, plan_old_pct. A trip
    without a percentage counts in the number but not in the mean.
    """
    return _plan_rows(trips).select("plan_id", "plan_pct")


def _plan_rows(trips: DataFrame) -> DataFrame:
    number = F.count("trip_id")
    old = F.col("plan_old_pct") * F.col("active_trips")
    new = F.avg("trip_pct").cast("double") * number
    return trips.groupBy("plan_id", "active_trips", "plan_old_pct").agg(
        ratio(old + new, F.col("active_trips") + number).alias("plan_pct"),
        F.min(F.struct("service_id", "contract_id", "group_id")).alias("owner"),
    )


def plan_summary(lifted: DataFrame, swept: DataFrame) -> DataFrame:
    """One row per plan of either service: percent, service, contract, group. Lifting goes first."""

    def rows(trips: DataFrame, source: int) -> DataFrame:
        return _plan_rows(trips).select("plan_id", "plan_pct", "owner.*", F.lit(source).alias("source"))

    both = rows(lifted, LIFTING).unionByName(rows(swept, SWEEPING))
    return first_per(both, ["plan_id"], [F.col("source"), F.col("service_id")]).drop("source")


def _replaced(rows: DataFrame, results: DataFrame, keys: dict[str, str], value: str, zero_for_null: bool) -> DataFrame:
    """Rows whose key has a result take ``value`` as completion_pct; ``keys`` maps row to result columns."""
    new = results.select(
        *(F.col(theirs).alias(ours) for ours, theirs in keys.items()),
        F.col(value).alias("_new"),
        F.lit(True).alias("_hit"),
    )
    found = F.coalesce("_new", F.lit(0.0)) if zero_for_null else F.col("_new")
    return (
        rows.join(new, list(keys), "left")
        .withColumn("completion_pct", F.when(F.col("_hit"), found).otherwise(F.col("completion_pct")))
        .drop("_new", "_hit")
    )


def plan_state(plans: DataFrame, summary: DataFrame) -> DataFrame:
    return _replaced(plans, summary, {"id": "plan_id"}, "plan_pct", zero_for_null=False)


def service_completion(summary: DataFrame, plans: DataFrame, services: DataFrame) -> DataFrame:
    """Mean over all plans of each service that has a plan in the batch. ``plans`` is the new state."""
    touched = summary.select("service_id").distinct()
    known = services.select(F.col("id").alias("service_id"))
    return (
        plans.select("service_id", "completion_pct")
        .join(touched, "service_id", "left_semi")
        .join(known, "service_id", "left_semi")
        .groupBy("service_id")
        .agg(F.avg("completion_pct").alias("service_pct"))
    )


def service_state(services: DataFrame, results: DataFrame) -> DataFrame:
    return _replaced(services, results, {"id": "service_id"}, "service_pct", zero_for_null=False)


def group_completion(groups: DataFrame, services: DataFrame) -> DataFrame:
    """Weighted mean of the services of each contract and group. ``services`` is the new state."""
    return (
        groups.select("contract_id", "group_id")
        .join(services.select("contract_id", "group_id", "completion_pct", "weight_in_group"), ["contract_id", "group_id"])
        .groupBy("contract_id", "group_id")
        .agg(weighted_mean(F.col("completion_pct"), F.col("weight_in_group")).alias("group_pct"))
    )


def group_state(groups: DataFrame, results: DataFrame) -> DataFrame:
    keys = {"contract_id": "contract_id", "group_id": "group_id"}
    return _replaced(groups, results, keys, "group_pct", zero_for_null=True)


def contract_completion(groups: DataFrame) -> DataFrame:
    """Weighted mean of the groups of each contract. ``groups`` is the new state."""
    mean = weighted_mean(F.col("completion_pct") / 100, F.col("weight_in_contract"))
    return groups.groupBy("contract_id").agg((mean * 100).alias("contract_pct"))


def contract_state(contracts: DataFrame, results: DataFrame) -> DataFrame:
    return _replaced(contracts, results, {"id": "contract_id"}, "contract_pct", zero_for_null=True)


def roll_up(
    summary: DataFrame, fleet, settle: Callable[[DataFrame], DataFrame] = lambda df: df
) -> dict[str, DataFrame]:
    """Results and new states of every level above the trip, from :func:`plan_summary`.

    ``settle`` is applied to the results per service and per group, which the
    levels above and the log all read.
    """
    plans = plan_state(fleet.plans, summary)
    service_pct = settle(service_completion(summary, plans, fleet.services))
    services = service_state(fleet.services, service_pct)
    group_pct = settle(group_completion(fleet.contract_groups, services))
    groups = group_state(fleet.contract_groups, group_pct)
    contract_pct = contract_completion(groups)
    return {
        "plan_pct": summary, "plans": plans,
        "service_pct": service_pct, "services": services,
        "group_pct": group_pct, "contract_groups": groups,
        "contract_pct": contract_pct, "contracts": contract_state(fleet.contracts, contract_pct),
    }


def log_percentages(log: DataFrame, results: dict[str, DataFrame], day: dt.date) -> DataFrame:
    """Write the percentages of :func:`roll_up` into the log rows of ``day``; unknown counts as 0."""
    today = F.col("created_date") == date_lit(day)

    def put(df: DataFrame, level: str, keys: list[str]) -> DataFrame:
        column = f"{level}_pct"
        new = results[column].select(*keys, F.coalesce(column, F.lit(0.0)).alias("_new"))
        value: Column = F.when(today & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(column))
        return df.join(new, keys, "left").withColumn(column, value).drop("_new")

    for level, keys in (
        ("plan", ["plan_id"]),
        ("service", ["service_id"]),
        ("group", ["contract_id", "group_id"]),
        ("contract", ["contract_id"]),
    ):
        log = put(log, level, keys)
    return log
