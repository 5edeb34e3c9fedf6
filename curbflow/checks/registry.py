"""Where queries and their SQL twins are registered."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbflow.checks.sql_views import statement
from curbflow.plans.batch import Batch
from curbflow.sources.derived import DerivedFleet

# The day trips are created for, and the clock of that run.
TODAY = dt.date(2024, 1, 10)
NOW = dt.datetime(2024, 1, 10, 9, 30)
# The clock of the ping batch, which holds all pings of the month.
LOG_DAY = dt.date(2024, 1, 30)

# Results are compared as rounded doubles: sums of floats differ in the last digits between engines.
DIGITS = 4

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    """Register the decorated function of a batch under ``name``, with its SQL twin."""

    def register(build: Callable[[Batch], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Batch(DerivedFleet(spark, folder)))
        if sql is not None:
            ORACLES[name] = statement(sql)
        return build

    return register


def rounded(*names: str) -> list[Column]:
    return [F.round(F.col(name), DIGITS).alias(name) for name in names]


def r_sql(*names: str) -> str:
    return ", ".join(f"round({name}, {DIGITS}) as {name}" for name in names)
