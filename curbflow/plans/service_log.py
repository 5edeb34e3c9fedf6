"""Daily log of percentages: seeded per contract and group, then one row per plan seen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from curbflow.functions.keys import derived_key
from curbflow.functions.time import date_lit, timestamp_lit
from curbflow.operators import first_per

LOG_KEYS = ("plan_id", "service_id", "contract_id", "group_id", "company_id")
# What a plan's row holds beside its keys.
LOG_VALUES = ("group_type", "contract_type_id")
# Fixed value: group type of a seeded row and contract type of every new row.
NO_TYPE = 0


def seed_rows(log: DataFrame, fleet, day: dt.date, now: dt.datetime) -> DataFrame:
    """A row of zeros per service of each contract group that ``day`` has no row for yet."""
    logged = log.where(
        (F.col("created_date") == date_lit(day)) & (F.col("logged_at").cast("date") == date_lit(day))
    ).select("contract_id", "group_id")
    zero = F.lit(0.0)
    key_type = log.schema["id"].dataType
    return (
        fleet.contract_groups.select("contract_id", "group_id")
        .join(logged, ["contract_id", "group_id"], "left_anti")
        .join(
            fleet.contracts.select(F.col("id").alias("contract_id"), "company_id", "contract_type_id"), "contract_id"
        )
        .join(
            fleet.services.select("contract_id", "group_id", F.col("id").alias("of_service")), ["contract_id", "group_id"]
        )
        .join(fleet.contract_types.select(F.col("id").alias("contract_type_id")), "contract_type_id", "left_semi")
        .select(
            derived_key(key_type, F.lit("seed"), date_lit(day), "contract_id", "group_id", "of_service").alias("id"),
            "contract_id", "group_id", "company_id",
            date_lit(day).alias("created_date"), timestamp_lit(now).alias("logged_at"),
            F.lit("seed").alias("created_by"),
            F.lit(NO_TYPE).alias("group_type"), "contract_type_id", F.lit(NO_TYPE).alias("contract_type"),
            zero.alias("service_pct"), zero.alias("group_pct"), zero.alias("contract_pct"),
        )
    )


def plan_rows(lift_contexts: DataFrame, locations: DataFrame) -> DataFrame:
    """Log keys of the plans seen: one row per plan and service kind, lifting first where all keys agree."""

    def of(df: DataFrame, label: str, rank: int) -> DataFrame:
        keys = df.groupBy("plan_id").agg(F.min(F.struct(*LOG_KEYS[1:], *LOG_VALUES)).alias("k"))
        return keys.select("plan_id", "k.*", F.lit(label).alias("seen_by"), F.lit(rank).alias("_rank"))

    both = of(lift_contexts, "lifting", 0).unionByName(of(locations, "sweeping", 1))
    return first_per(both, list(LOG_KEYS), [F.col("_rank")]).drop("_rank")


def upsert(log: DataFrame, rows: DataFrame, day: dt.date, now: dt.datetime) -> DataFrame:
    """The log with ``rows`` merged into ``day``: known keys are marked, new keys are added.

    Keys compare with plain equality, so a seeded row (no plan) is never marked.
    """
    today = F.col("created_date") == date_lit(day)
    marks = rows.select(*LOG_KEYS, "seen_by")
    marked = (
        log.join(marks, list(LOG_KEYS), "left")
        .withColumn("modified_date", F.when(today & F.col("seen_by").isNotNull(), timestamp_lit(now)).otherwise(F.col("modified_date")))
        .withColumn("modified_by", F.when(today, F.coalesce("seen_by", "modified_by")).otherwise(F.col("modified_by")))
        .drop("seen_by")
    )
    added = rows.join(log.where(today).select(*LOG_KEYS), list(LOG_KEYS), "left_anti").select(
        derived_key(log.schema["id"].dataType, date_lit(day), *LOG_KEYS).alias("id"),
        *LOG_KEYS,
        *LOG_VALUES,
        F.lit(NO_TYPE).alias("contract_type"),
        date_lit(day).alias("created_date"),
        timestamp_lit(now).alias("logged_at"),
        F.col("seen_by").alias("created_by"),
    )
    return marked.unionByName(added, allowMissingColumns=True)
