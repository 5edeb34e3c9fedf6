"""Fleet tables kept as Parquet, one partition per run that wrote them.

    <root>/<table>/run=<run>/...     rows added or changed by a run; tables of trips by trip_day below that
    <root>/_ledger/run=<run>/...     one row, written last: the run counts from here on

A run that dies half-way leaves partitions that no ledger row names; nobody
reads them, and its next attempt writes over them. A run that is in the ledger
is not done again. Keyed tables are read as: rows of the base that no later run
changed, and the latest change of each key. The base is not shuffled when the
changed keys are few enough to broadcast, which Spark decides by their size.
``compact`` writes a new base of each table and so bounds the number of runs read.
A run names the tables it wrote; a table's base is the latest base run that has it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbflow.operators import first_per
from curbflow.operators.nearby import CELLS_TYPE
from curbflow.plans.history import TRIP_DAY

LEDGER = "_ledger"
ORDER = "_order"

# Tables whose rows change, with their keys; all others only grow or stay.
KEYS: dict[str, tuple[str, ...]] = {
    "bins": ("id",),
    "contract_groups": ("contract_id", "group_id"),
    "contracts": ("id",),
    "plans": ("id",),
    "service_log": ("id",),
    "services": ("id",),
    "stop_summaries": ("id",),
    "streets": ("id",),
    "trip_summaries": ("id",),
    "trips": ("id",),
}

# Tables that are kept from run to run only if they were started (see ``curbflow.streaming.ping_stream``).
KEPT_KEYS: dict[str, tuple[str, ...]] = {
    "creation_clock": ("id",),
    "history_clock": ("id",),
    "known_tags": ("tag_key",),
    "last_positions": ("vehicle_id",),
    "plan_trip_counts": ("plan_id",),
    "tag_history": ("tag_key", "vehicle_id"),
    "vehicle_history": ("vehicle_id",),
}

# Tables whose rows belong to a trip; they are stored by the day on which it ends.
OF_TRIPS = ("crew_trips", "stop_summaries", "stops", "trip_summaries", "trip_texts", "trips")


# Columns that runs write beside those of the first fill, in their types; they are null in rows written without them.
ADDED_COLUMNS: dict[str, dict[str, str]] = {
    "stops": {"reference_code": "string", "tag_hash": "string"},
    # The grid cells of a street, see ``curbflow.plans.sweeping.with_cells``.
    "streets": {"cells": CELLS_TYPE},
    # Ids of other tables as text, which holds keys of any type.
    "tag_violations": {
        "tag_key": "string", "ping_id": "bigint", "longitude": "double", "latitude": "double",
        "bin_company_id": "string", "bin_contract_type": "string",
    },
    "trip_summaries": {"discharge_status": "int"},
}


def keys_of(name: str) -> tuple[str, ...] | None:
    """The key columns of a table whose rows change; None if its rows only grow."""
    return KEYS.get(name) or KEPT_KEYS.get(name)


class StateTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # ---- ledger: one row per run; what is read of it is cut down in Spark ----

    def _ledger(self) -> DataFrame | None:
        return self._stored(LEDGER)

    def _stored(self, name: str) -> DataFrame | None:
        """All rows ever written to a table; None if nothing was. Any other failure is one."""
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def runs(self, name: str) -> list[tuple[int, str, bool]]:
        """(order, run, is_base) of the finished runs of a table from its latest base on, oldest first."""
        ledger = self._ledger()
        if ledger is None:
            return []
        of_table = ledger.where(F.array_contains("tables", name))
        base = of_table.where("is_base").agg(F.max("order_no").alias("base"))
        rows = of_table.join(base, F.col("order_no") >= F.coalesce("base", F.lit(0))).collect()
        return sorted((row["order_no"], row["run"], row["is_base"]) for row in rows)

    def tables(self) -> list[str]:
        """Every table that a finished run wrote."""
        ledger = self._ledger()
        if ledger is None:
            return []
        return sorted(row["table"] for row in ledger.select(F.explode("tables").alias("table")).distinct().collect())

    def is_done(self, run: str) -> bool:
        ledger = self._ledger()
        return ledger is not None and not ledger.where(F.col("run") == run).isEmpty()

    def _next(self) -> int:
        ledger = self._ledger()
        return 1 if ledger is None else ledger.agg(F.coalesce(F.max("order_no"), F.lit(0))).first()[0] + 1

    # ---- tables ----

    def write(self, run: str, tables: Mapping[str, DataFrame], is_base: bool = False) -> None:
        """Write all ``tables`` of a run, then its ledger row, under one order number.

        Runs are applied one after another: a second writer at the same time is not supported.
        """
        order = self._next()
        for name, rows in tables.items():
            place = f"{self.root}/{name}/run={run}"
            fitted = self._fitted(name, rows).withColumn(ORDER, F.lit(order))
            writer = fitted.write.mode("overwrite")
            if name in OF_TRIPS:
                writer = writer.partitionBy(TRIP_DAY)
            writer.parquet(place)
            stored = self.spark.read.schema(fitted.schema).parquet(place)
            if name in OF_TRIPS and stored.isEmpty():
                # Without a day there would be no file, and so no columns.
                fitted.limit(0).drop(TRIP_DAY).write.mode("overwrite").parquet(f"{place}/{TRIP_DAY}=__HIVE_DEFAULT_PARTITION__")
            self._check_keys(name, stored)
        row = self.spark.range(1).select(
            F.lit(order).alias("order_no"), F.lit(is_base).alias("is_base"),
            F.array(*(F.lit(name) for name in sorted(tables))).cast("array<string>").alias("tables"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{LEDGER}/run={run}")

    def _check_keys(self, name: str, stored: DataFrame) -> None:
        """Two rows of one key in a run would hide one another."""
        keys = keys_of(name)
        if keys is None:
            return
        twice = stored.groupBy(*keys).count().where("count > 1").take(1)
        if twice:
            raise ValueError(f"{name} has several rows of the key {twice[0].asDict()}")

    def _fitted(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows in the columns and types of the table: those of its first fill and ADDED_COLUMNS. Others are an error."""
        written = self._stored(name)
        stored = rows.schema if written is None else written.drop("run", ORDER).schema
        columns = {field.name: field.dataType for field in stored}
        columns |= {column: kind for column, kind in ADDED_COLUMNS.get(name, {}).items() if column not in columns}
        if name in OF_TRIPS:
            columns[TRIP_DAY] = "date"
        unknown = sorted(set(rows.columns) - set(columns))
        if unknown:
            raise ValueError(f"{name} has no columns {unknown}")
        return rows.select(
            *((F.col(column) if column in rows.columns else F.lit(None)).cast(kind).alias(column) for column, kind in columns.items())
        )

    def read(self, name: str, days: Column | None = None) -> DataFrame:
        """Current rows of a table; of a table of trips those whose trip_day meets the condition ``days``."""
        runs = self.runs(name)
        stored = self.spark.read.parquet(f"{self.root}/{name}")
        stored = stored.where(F.col("run").isin([run for _, run, _ in runs])).drop("run")
        if name in OF_TRIPS:
            # No row changes its day, so the days are chosen before the latest change is, and other folders are not read.
            stored = stored.withColumn(TRIP_DAY, F.col(TRIP_DAY).cast("date"))
            stored = stored if days is None else stored.where(days)
        keys = keys_of(name)
        if keys is None:
            return stored.drop(ORDER)
        base_order = runs[0][0] if runs and runs[0][2] else 0
        # Rows of one key have one day, so a filter on the day passes the choice of the latest change.
        unit = [*keys, TRIP_DAY] if name in OF_TRIPS else list(keys)
        changes = first_per(stored.where(F.col(ORDER) > base_order), unit, [F.desc(ORDER)]).drop(ORDER)
        base = stored.where(F.col(ORDER) <= base_order).drop(ORDER)
        return base.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)

    def since(self, name: str, order: int) -> DataFrame:
        """Rows that finished runs added or changed after the run of an order number, as they are now."""
        runs = [run for number, run, _ in self.runs(name) if number > order]
        stored = self.spark.read.parquet(f"{self.root}/{name}")
        changed = stored.where(F.col("run").isin(runs) & (F.col(ORDER) > order)).drop("run")
        keys = keys_of(name)
        return (changed if keys is None else first_per(changed, keys, [F.desc(ORDER)])).drop(ORDER)

    def last_order(self) -> int:
        """The order number of the latest finished run."""
        return self._next() - 1

    def load(self, run: str, tables: Mapping[str, DataFrame]) -> None:
        """First fill of all tables; they form the base."""
        self.write(run, tables, is_base=True)

    def compact(self, run: str, names: list[str] | None = None) -> None:
        """Write the current rows of tables, of all by default, as their new base. Other tables keep theirs."""
        if not self.is_done(run):
            self.write(run, {name: self.read(name) for name in names or self.tables()}, is_base=True)

    def once(self, run: str, work: Callable[[], Mapping[str, DataFrame]]) -> bool:
        """Do ``work`` and write its tables unless the run is done already; True if it was done now."""
        if self.is_done(run):
            return False
        self.write(run, work())
        return True


class StoredFleet:
    """Current tables as attributes, with the pings of one batch."""

    def __init__(self, state: StateTables, pings: DataFrame | None = None):
        self._state = state
        self._read: dict[str, DataFrame] = {} if pings is None else {"pings": pings}

    def put(self, name: str, rows: DataFrame) -> None:
        """Use ``rows`` in place of the stored table."""
        self._read[name] = rows

    def on_days(self, days: list[dt.date], since: dt.date) -> None:
        """Cut the tables of trips down to trips that end on one of ``days``, on ``since`` or later, or on no known day."""
        for name in OF_TRIPS:
            day = F.col(TRIP_DAY)
            if name in self._state.tables():
                self.put(name, self._state.read(name, day.isNull() | day.isin(days) | (day >= F.lit(since.isoformat()).cast("date"))))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self._state.read(name)
        return self._read[name]
