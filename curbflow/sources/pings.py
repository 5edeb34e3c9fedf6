"""Split a ping batch into tag reads (bin lifts) and position reads (street sweeping)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbflow.functions.text import is_untagged, is_usable_tag, tag_key
from curbflow.operators import first_per

# What the lifting steps need of a ping; the sensor inputs are not read.
READ_COLUMNS = ("id", "vehicle_id", "longitude", "latitude", "tag", "movement_time", "imei", "io9")

# Fixed value: stands for an unknown contract type, company or tenant.
NO_ID = "00000000-0000-0000-0000-000000000000"


def lift_reads(pings: DataFrame, vehicles: DataFrame) -> DataFrame:
    """First ping of every usable tag, with the owner columns of its vehicle (``NO_ID`` if unknown)."""
    owners = vehicles.select(
        F.col("id").alias("vehicle_id"),
        *(F.col(name).cast("string").alias(name) for name in ("contract_type_id", "company_id", "tenant_id")),
    )
    # One row per tag goes on to the join, so the batch is reduced first.
    first = first_per(
        pings.select(*READ_COLUMNS, tag_key(F.col("tag")).alias("tag_key")).where(is_usable_tag(F.col("tag"))),
        ["tag_key"],
        [F.col("movement_time"), F.col("id")],
    )
    return first.join(owners, "vehicle_id", "left").fillna(NO_ID, ["contract_type_id", "company_id", "tenant_id"])


def sweep_reads(pings: DataFrame) -> DataFrame:
    """Pings without a tag."""
    return pings.where(is_untagged(F.col("tag")))


def overlong_tags(pings: DataFrame) -> DataFrame:
    """Pings that belong to neither branch: their tag is too long to be matched."""
    return pings.where(~is_untagged(F.col("tag")) & ~is_usable_tag(F.col("tag")))


def new_tag_references(lifts: DataFrame, references: DataFrame) -> DataFrame:
    """Position of each tag that has no reference position yet."""
    known = references.select(tag_key(F.col("tag")).alias("tag_key"))
    return lifts.join(known, "tag_key", "left_anti").select("tag", "tag_key", "longitude", "latitude")
