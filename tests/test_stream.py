"""Stored tables and the stream: batches count once, a lost run leaves no trace."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from curbflow.sources.derived import TABLES, DerivedFleet
from curbflow.sources.state import KEYS, StateTables
from curbflow.streaming.ping_stream import PING_SCHEMA, apply_batch, create_trips, run_name, run_stream

SCRATCH = {"pings", "users", "vehicle_days"}
WATCHED = ["bins", "stops", "stop_summaries", "trip_summaries", "plans", "contracts", "service_log", "tag_violations"]


def image(state):
    """Row count and content hash of the tables a batch writes."""
    return {
        name: tuple(state.read(name).select(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first())
        for name in WATCHED
    }



@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("fleet")
    fleet = DerivedFleet(spark, SF_DIR)
    state = StateTables(spark, str(root / "state"))
    state.load("load", {name: getattr(fleet, name) for name in TABLES if name not in SCRATCH})
    pings = fleet.pings.where("movement_time < timestamp_ntz '2024-01-08'")
    pings.select(*PING_SCHEMA.names).coalesce(1).write.parquet(str(root / "pings"))
    return state, root


def test_stream_applies_each_batch_once(spark, loaded):
    state, root = loaded
    before = image(state)
    stream = spark.readStream.schema(PING_SCHEMA).parquet(str(root / "pings"))
    query = run_stream(stream, state, str(root / "checkpoint"), available_now=True)
    query.awaitTermination()
    after = image(state)
    assert after["stop_summaries"] != before["stop_summaries"]
    assert after["service_log"][0] > before["service_log"][0]
    # The same batch again, by its run name.
    pings = spark.read.schema(PING_SCHEMA).parquet(str(root / "pings"))
    done = run_name(spark, str(root / "checkpoint"), "pings", 0)
    assert state.is_done(done)
    assert apply_batch(state, pings, done) == 0
    assert image(state) == after
    # Percentages stay within bounds after the update.
    for name in ("stop_summaries", "trip_summaries"):
        low, high = state.read(name).select(F.min("completion_pct"), F.max("completion_pct")).first()
        assert 0 <= low <= high <= 100
    for name, keys in KEYS.items():
        rows = state.read(name)
        assert rows.count() == rows.select(*keys).distinct().count()


def test_unfinished_run_is_not_read(spark, loaded):
    state, root = loaded
    before = image(state)
    stray = state.read("bins").withColumn("longitude", F.lit(0.0)).withColumn("_order", F.lit(99))
    stray.write.parquet(f"{state.root}/bins/run=lost")
    assert image(state) == before
    state.compact("compact-some", ["trips"])
    assert image(state) == before
    state.compact("compact-all")
    assert image(state) == before
    assert all(len(state.runs(name)) == 1 for name in state.tables())


def test_unknown_columns_and_repeated_keys_are_errors(spark, loaded):
    state, _ = loaded
    bins = state.read("bins").limit(3)
    with pytest.raises(ValueError, match="no columns"):
        state.write("odd", {"bins": bins.withColumn("colour", F.lit("green"))})
    with pytest.raises(ValueError, match="several rows"):
        state.write("twice", {"bins": bins.unionByName(bins)})
    assert not state.is_done("odd") and not state.is_done("twice")


def test_pings_without_a_usable_clock_are_set_aside(spark, loaded):
    state, root = loaded
    pings = spark.read.schema(PING_SCHEMA).parquet(str(root / "pings")).limit(5)
    timeless = pings.withColumn("movement_time", F.lit(None).cast("timestamp_ntz"))
    assert apply_batch(state, timeless, "timeless") == 1
    assert state.read("faulty_pings").count() == 5
    early = dt.datetime(2023, 12, 1)
    assert apply_batch(state, pings, "ahead", arrived=early) == 1
    assert state.read("faulty_pings").count() == 10


def test_a_new_checkpoint_is_a_new_stream(spark, loaded):
    state, root = loaded
    fleet = DerivedFleet(spark, SF_DIR)
    later = fleet.pings.where("movement_time >= timestamp_ntz '2024-01-08' and movement_time < timestamp_ntz '2024-01-09'")
    later.select(*PING_SCHEMA.names).coalesce(1).write.parquet(str(root / "later"))
    before = image(state)
    stream = spark.readStream.schema(PING_SCHEMA).parquet(str(root / "later"))
    run_stream(stream, state, str(root / "checkpoint-2"), available_now=True).awaitTermination()
    assert state.is_done(run_name(spark, str(root / "checkpoint-2"), "pings", 0))
    assert image(state) != before


def test_trip_creation_is_stored_once(spark, loaded):
    state, _ = loaded
    before = state.read("trips").count()
    now = dt.datetime(2024, 1, 10, 9, 30)
    assert create_trips(state, now.date(), now) == 1
    trips = state.read("trips")
    made = trips.where("reference_code is not null")
    assert made.count() == trips.count() - before > 0
    assert made.select("reference_code").distinct().count() == made.count()
    assert create_trips(state, now.date(), now) == 0
    assert state.read("trips").count() == trips.count()
    # What the trip tables take beside the columns of the first fill is kept.
    new_stops = state.read("stops").join(made.select(F.col("id").alias("trip_id")), "trip_id", "left_semi")
    assert new_stops.where("tag is not null and tag_hash is null").isEmpty()
    assert state.read("trip_summaries").where("discharge_status is not null").count() > 0
    # Later in the day the run makes no trip twice and starts those that are due.
    planned = made.where("status = 1 and start_trip <= timestamp_ntz '2024-01-10 18:00:00'").count()
    assert create_trips(state, now.date(), now.replace(hour=17)) == 1
    again = state.read("trips")
    assert again.groupBy("plan_id", "start_trip").count().where("count > 1").count() == trips.groupBy("plan_id", "start_trip").count().where("count > 1").count()
    assert again.where("status = 1 and start_trip <= timestamp_ntz '2024-01-10 18:00:00' and reference_code is not null").count() == 0
    assert planned >= 0
    # Every new stop has a summary of its own.
    stops = state.read("stops").join(made.select(F.col("id").alias("trip_id")), "trip_id", "left_semi")
    assert stops.count() == stops.select("id").distinct().count()
    assert stops.select(F.col("id").alias("stop_id")).join(state.read("stop_summaries"), "stop_id", "left_anti").count() == 0
