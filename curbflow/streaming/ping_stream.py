"""Run ping batches from a stream, each exactly once on the stored tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from curbflow.functions.time import timestamp_lit
from curbflow.plans.batch import Batch, Choices
from curbflow.plans.history import TRIP_DAY, History, by_vehicle, first_history
from curbflow.plans.sweeping import LAST_POSITION, with_cells
from curbflow.plans.trip_creation import Kept, TripRun, advance_status, counts_forward, started_trips_of_plans
from curbflow.session import cut_lineage
from curbflow.sources.state import StateTables, StoredFleet

PING_SCHEMA = StructType(
    [
        StructField("id", LongType(), False),
        StructField("vehicle_id", LongType()),
        StructField("longitude", DoubleType()),
        StructField("latitude", DoubleType()),
        StructField("tag", StringType()),
        StructField("movement_time", TimestampNTZType()),
        StructField("imei", StringType()),
        StructField("input1", LongType()),
        StructField("input2", LongType()),
        StructField("input3", LongType()),
        StructField("input4", LongType()),
        StructField("speed", LongType()),
        StructField("ignition", BooleanType()),
        StructField("io9", DoubleType()),
    ]
)


# How far a ping's clock may be ahead of its arrival.
AHEAD = dt.timedelta(hours=1)


def latest_ping(pings: DataFrame) -> dt.datetime:
    """Default clock of a batch: its latest ping, so that a re-run has the same clock."""
    return pings.agg(F.max("movement_time")).first()[0]


def timely(pings: DataFrame, arrived: dt.datetime | None) -> tuple[DataFrame, DataFrame]:
    """Pings with a usable clock, and the others: no time, or a time past ``arrived`` and AHEAD."""
    good = F.col("movement_time").isNotNull()
    if arrived is not None:
        good = good & F.coalesce(F.col("movement_time") <= timestamp_lit(arrived + AHEAD), F.lit(False))
    return pings.where(good), pings.where(~good)


def apply_batch(
    state: StateTables,
    pings: DataFrame,
    run: str,
    clock: Callable[[DataFrame], dt.datetime] = latest_ping,
    choices: Choices = Choices(),
    arrived: dt.datetime | None = None,
) -> int:
    """Process a batch and write what it changes. 1 if done now, 0 if empty or done before.

    Planned trips that are due by the batch's clock start before the pings are matched. Pings whose clock is
    missing or past ``arrived`` go to the table faulty_pings and nowhere else. A failure raises; nothing of the
    batch counts then, and the stream brings it again.
    """
    if state.is_done(run) or pings.isEmpty():
        return 0
    good, faulty = timely(pings, arrived)
    faulty = {"faulty_pings": faulty.select(*PING_SCHEMA.names)}
    now = clock(good)
    if now is None:
        return int(state.once(run, lambda: faulty))
    return int(state.once(run, lambda: {**batch_changes(state, good, now, choices), **faulty}))


def batch_changes(state: StateTables, pings: DataFrame, now: dt.datetime, choices: Choices) -> dict[str, DataFrame]:
    """Rows that every table takes from a batch, the kept history among them if there is one."""
    fleet = StoredFleet(state, pings)
    if choices.carry_positions and "last_positions" not in state.tables():
        fleet.put("last_positions", state.spark.createDataFrame([], LAST_POSITION))
    all_trips, all_stops = fleet.trips, fleet.stops
    history = stored_history(state)
    first_ping = pings.agg(F.min("movement_time")).first()[0]
    # Pings from before the history's clock may belong to any trip.
    in_time = history is not None and first_ping >= history.as_of
    batch = Batch(fleet, choices, now, history if in_time else None)
    if in_time:
        fleet.on_days(batch.trip_days(), min(first_ping, history.as_of).date())
    started = started_trips(fleet.trips, now)
    fleet.put("trips", advance_status(fleet.trips, now))
    changes = {**batch.changes(), "trips": started}
    changes["streets"] = with_cells(changes["streets"])
    days = fleet.trips.select(F.col("id").alias("trip_id"), F.to_date("end_trip").alias(TRIP_DAY))
    stops = cut_lineage(on_trip_days(changes["stops"], days, "trip_id"))
    of_stops = stops.select(F.col("id").alias("stop_id"), TRIP_DAY)
    changes["stops"] = stops
    changes["stop_summaries"] = filled_days(changes["stop_summaries"], of_stops, "stop_id")
    if history is not None:
        changes |= history.changes(now, all_trips, all_stops, stops, fleet.trips)
    return changes


def on_trip_days(rows: DataFrame, days: DataFrame, key: str) -> DataFrame:
    """Rows with the day of their trip, which ``days`` has by ``key``."""
    return rows.drop(TRIP_DAY).join(days, key, "left")


def filled_days(rows: DataFrame, days: DataFrame, key: str) -> DataFrame:
    """Rows with the day they are stored under, and that of ``days`` where they have none yet."""
    if TRIP_DAY not in rows.columns:
        return on_trip_days(rows, days, key)
    known = rows.join(days.withColumnRenamed(TRIP_DAY, "_day"), key, "left")
    return known.withColumn(TRIP_DAY, F.coalesce(TRIP_DAY, "_day")).drop("_day")


def first_fill(state: StateTables, run: str, tables: Mapping[str, DataFrame], as_of: dt.datetime | None = None) -> None:
    """Fill all tables: those of trips by the day the trip ends, streets with their cells, and with ``as_of`` the history
    of the trips that ended before, which batches keep up from then on."""
    tables = dict(tables)
    trips = tables["trips"] = tables["trips"].withColumn(TRIP_DAY, F.to_date("end_trip"))
    days = trips.select(F.col("id").alias("trip_id"), TRIP_DAY)
    tables["stops"] = on_trip_days(tables["stops"], days, "trip_id")
    of_stops = tables["stops"].select(F.col("id").alias("stop_id"), TRIP_DAY)
    for name, by, key in (("trip_summaries", days, "trip_id"), ("crew_trips", days, "trip_id"), ("stop_summaries", of_stops, "stop_id")):
        if name in tables:
            tables[name] = on_trip_days(tables[name], by, key)
    if "streets" in tables:
        tables["streets"] = with_cells(tables["streets"])
    state.load(run, tables)
    if as_of is not None:
        state.once(f"{run}-history", lambda: first_history(StoredFleet(state), as_of))


def creation_row(state: StateTables, as_of: dt.datetime, made: int) -> DataFrame:
    """The clock of trip creation: when, how many trips there are, and up to which run changes are taken in."""
    order = state.last_order()
    return state.spark.range(1).select(
        F.lit(1).alias("id"), timestamp_lit(as_of).alias("as_of"), F.lit(made).cast("bigint").alias("made"), F.lit(order).cast("bigint").alias("order_no")
    )


def keep_creation(state: StateTables, run: str, as_of: dt.datetime) -> None:
    """Start to keep what trip creation needs of all trips: their number, and how many of each plan started by ``as_of``.

    Trips that are deleted later still count as made and started, as they do when all are counted."""

    def work() -> dict[str, DataFrame]:
        trips = state.read("trips")
        return {"plan_trip_counts": started_trips_of_plans(trips, as_of), "creation_clock": creation_row(state, as_of, trips.count()).withColumn("order_no", F.lit(0).cast("bigint"))}

    state.once(run, work)


def kept_creation(state: StateTables, fleet: StoredFleet) -> Kept | None:
    if "creation_clock" not in state.tables():
        return None
    clock = state.read("creation_clock").first()
    order = clock["order_no"]
    columns = ["id", "plan_id", "is_deleted"]
    found = state.since("trips", order).select(*columns)
    # Trips that did not change are looked for only where the crews of their plan, or their own, did.
    of_plans = state.since("crew_plans", order).select("plan_id").distinct()
    of_trips = state.since("crew_trips", order).select(F.col("trip_id").alias("id")).distinct()
    for rows, key in ((of_plans, "plan_id"), (of_trips, "id")):
        if not rows.isEmpty():
            found = found.unionByName(fleet.trips.join(rows, key, "left_semi").select(*columns))
    return Kept(clock["as_of"], clock["made"], state.read("plan_trip_counts"), found)


def stored_history(state: StateTables) -> History | None:
    if "history_clock" not in state.tables():
        return None
    as_of = state.read("history_clock").first()["as_of"]
    return History(as_of, state.read("vehicle_history"), state.read("tag_history"), state.read("known_tags"))


def started_trips(trips: DataFrame, now: dt.datetime) -> DataFrame:
    """Trips whose status changes by ``now``."""
    return advance_status(trips.withColumn("_old", F.col("status")), now).where("_old <> status").drop("_old")


def ping_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of ping files (Parquet) in a folder."""
    return spark.readStream.schema(PING_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_stream(
    pings: DataFrame,
    state: StateTables,
    checkpoint: str,
    name: str = "pings",
    clock: Callable[[DataFrame], dt.datetime] = latest_ping,
    choices: Choices = Choices(),
    available_now: bool = False,
    every: str = "1 hour",
    arrival: Callable[[], dt.datetime | None] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
) -> StreamingQuery:
    """Apply every micro-batch.

    The stream's own id, which its checkpoint keeps, and the batch id name the run: a batch brought twice changes
    nothing, and a stream on a new checkpoint doesn't take its batches for those of the old one.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        apply_batch(state, batch, run_name(batch.sparkSession, checkpoint, name, batch_id), clock, choices, arrival())

    writer = pings.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_name(spark: SparkSession, checkpoint: str, name: str, batch_id: int) -> str:
    """The run of a batch: name, the id in the checkpoint's metadata, batch id."""
    stream_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return f"{name}-{stream_id}-{batch_id}"


def create_trips(state: StateTables, today: dt.date, now: dt.datetime) -> int:
    """Create the trips of ``today`` that don't exist yet and start those that are due; 1 if done now.

    May run again later in the day; a run is told by its clock.
    """
    fleet = StoredFleet(state)

    def work() -> dict[str, DataFrame]:
        kept = kept_creation(state, fleet)
        run = TripRun(fleet, today, now, kept)
        days = run.trips.select(F.col("id").alias("trip_id"), F.to_date("end_trip").alias(TRIP_DAY))
        stops = on_trip_days(run.stops, days, "trip_id")
        new = advance_status(run.trips, now).withColumn(TRIP_DAY, F.to_date("end_trip"))
        crews = run.crews.withColumn("is_deleted", F.lit(False))
        all_days = run.all_trips.select(F.col("id").alias("trip_id"), F.to_date("end_trip").alias(TRIP_DAY))
        made = {
            "trips": started_trips(fleet.trips, now).unionByName(new, allowMissingColumns=True),
            "trip_summaries": on_trip_days(run.summaries, days, "trip_id"),
            "stops": stops,
            "stop_summaries": on_trip_days(run.stop_summaries, stops.select(F.col("id").alias("stop_id"), TRIP_DAY), "stop_id"),
            "trip_texts": on_trip_days(run.texts, days, "trip_id"),
            "crew_trips": on_trip_days(crews, all_days, "trip_id"),
            "plans": run.plans.join(run.starts.select(F.col("plan_id").alias("id")), "id", "left_semi"),
        }
        if kept is not None and now >= kept.as_of:
            made["plan_trip_counts"] = counts_forward(kept, run.all_trips, now)
            made["creation_clock"] = creation_row(state, now, kept.made + run.trips.count())
        history = stored_history(state)
        if history is not None:
            # The clock stays; new trips that ended before it and new tags are taken in.
            forward = history.changes(history.as_of, fleet.trips, fleet.stops, run.stops, run.trips)
            ended = by_vehicle(run.trips.where(F.col("end_trip") < timestamp_lit(history.as_of)))
            later = ended.unionByName(history.vehicles.join(ended.select("vehicle_id"), "vehicle_id", "left_semi").select(*ended.columns))
            last = F.max(F.struct("end_trip", "trip_id")).alias("last")
            forward["vehicle_history"] = later.groupBy("vehicle_id").agg(last).select("vehicle_id", "last.*")
            made |= forward
        return made

    return int(state.once(f"trips-{today.isoformat()}-{now:%H%M%S}", work))
