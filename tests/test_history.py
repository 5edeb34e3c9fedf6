"""Kept history and storage by day: the same results as from the whole tables, on a part of them."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from curbflow.plans import matching, sweeping
from curbflow.plans.batch import Batch, Choices
from curbflow.plans.history import History, by_tag, by_vehicle, first_history, tags_of
from curbflow.plans.trip_creation import started_trips_of_plans
from curbflow.session import cut_lineage
from curbflow.sources.derived import TABLES, DerivedFleet
from curbflow.sources.pings import lift_reads
from curbflow.sources.state import OF_TRIPS, StateTables
from curbflow.streaming.ping_stream import apply_batch, create_trips, first_fill, keep_creation, stored_history

SCRATCH = {"pings", "users", "vehicle_days"}


def image(state, name):
    rows = state.read(name)
    return tuple(rows.select(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)"))).first())


def as_rows(df, *columns):
    return sorted(df.select(*columns).collect(), key=str)


@pytest.mark.parametrize("day", [3, 12, 31])
def test_matches_from_history_are_those_from_all_trips(spark, day):
    fleet, as_of = DerivedFleet(spark, SF_DIR), dt.datetime(2024, 1, day, 7, 20)
    tables = first_history(fleet, as_of)
    history = History(as_of, tables["vehicle_history"], tables["tag_history"], tables["known_tags"])
    moved = fleet.pings.withColumn("movement_time", F.col("movement_time") + F.make_dt_interval(F.lit(day - 1)))
    lifts = cut_lineage(lift_reads(moved.where(F.col("movement_time") >= F.lit(str(as_of)).cast("timestamp_ntz")), fleet.vehicles))
    whole = matching.match_lifts(lifts, cut_lineage(matching.tag_hits(lifts, fleet.stops, fleet.trips)), fleet.trips, fleet.stop_summaries)
    hits = cut_lineage(history.hits(lifts, fleet.stops, fleet.trips))
    part = matching.match_lifts(lifts, hits, history.trips(fleet.trips), fleet.stop_summaries)
    found = as_rows(whole, *matching.MATCH)
    assert as_rows(part, *matching.MATCH) == found and len({r.case_no for r in found}) >= 3


def test_history_brought_forward_is_that_of_all_trips(spark):
    fleet = DerivedFleet(spark, SF_DIR)
    tables = first_history(fleet, dt.datetime(2024, 1, 3))
    for to in (dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9, 12), dt.datetime(2024, 1, 20)):
        history = History(tables["history_clock"].first()["as_of"], tables["vehicle_history"], tables["tag_history"], tables["known_tags"])
        changed = history.changes(to, fleet.trips, fleet.stops, fleet.stops.limit(0), fleet.trips)
        for name, keys in (("vehicle_history", ["vehicle_id"]), ("tag_history", ["tag_key", "vehicle_id"])):
            kept = tables[name].join(changed[name].select(*keys), keys, "left_anti")
            tables[name] = cut_lineage(kept.unionByName(changed[name]))
        tables["history_clock"] = changed["history_clock"]
        ended = fleet.trips.where(F.col("end_trip") < F.lit(str(to)).cast("timestamp_ntz"))
        for name, want in (("vehicle_history", by_vehicle(ended)), ("tag_history", by_tag(fleet.stops, ended))):
            assert as_rows(tables[name], *want.columns) == as_rows(want, *want.columns)
    assert tables["known_tags"].count() == tags_of(fleet.stops).count()


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """Two stores of the same tables, one with history, after the same runs."""
    fleet = DerivedFleet(spark, SF_DIR)
    tables = {name: getattr(fleet, name) for name in TABLES if name not in SCRATCH}
    pings = fleet.pings.withColumn("movement_time", F.col("movement_time") + F.make_dt_interval(F.lit(2)))
    between = lambda low, high: pings.where(f"movement_time >= timestamp_ntz '2024-01-{low}' and movement_time < timestamp_ntz '2024-01-{high}'")
    made = []
    for as_of in (None, dt.datetime(2024, 1, 5)):
        state = StateTables(spark, str(tmp_path_factory.mktemp("state")))
        first_fill(state, "load", tables, as_of)
        now = dt.datetime(2024, 1, 10, 9, 30)
        create_trips(state, now.date(), now)
        # In time, later, and one that brings pings from before the history's clock.
        for run, (low, high) in {"a": ("10", "11"), "b": ("14", "15"), "late": ("12", "13")}.items():
            assert apply_batch(state, between(low, high), run) == 1
        made.append(state)
    return made


def test_batches_on_history_write_the_same_tables(stores):
    whole, part = stores
    assert stored_history(whole) is None and stored_history(part).as_of >= dt.datetime(2024, 1, 14)
    for name in whole.tables():
        assert image(part, name) == image(whole, name), name
    kept = first_history(type("Fleet", (), {"trips": whole.read("trips"), "stops": whole.read("stops")}), stored_history(part).as_of)
    for name in ("vehicle_history", "tag_history", "known_tags"):
        columns = kept[name].columns
        assert as_rows(part.read(name), *columns) == as_rows(kept[name], *columns), name


def test_rows_are_stored_by_the_day_of_their_trip(stores):
    for name in OF_TRIPS:
        if name in stores[1].tables() and name != "trip_texts":
            day = stores[1].read(name, F.col("trip_day") == F.lit("2024-01-10").cast("date"))
            assert day.count() == stores[1].read(name).where("trip_day = date '2024-01-10'").count() > 0, name
            plan = day._jdf.queryExecution().executedPlan().toString()
            scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
            assert scans and all("trip_day" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans), name
    trips = stores[1].read("trips")
    assert trips.where("trip_day <> to_date(end_trip)").isEmpty()
    odd = stores[1].read("stops").alias("s").join(trips.alias("t"), F.expr("s.trip_id = t.id")).where("not s.trip_day <=> t.trip_day")
    assert odd.isEmpty()


def test_creation_on_kept_counts_makes_the_same_trips(spark, tmp_path_factory):
    fleet = DerivedFleet(spark, SF_DIR)
    tables = {name: getattr(fleet, name) for name in TABLES if name not in SCRATCH}
    made = []
    for keep in (False, True):
        state = StateTables(spark, str(tmp_path_factory.mktemp("creation")))
        first_fill(state, "load", tables)
        if keep:
            keep_creation(state, "keep", dt.datetime(2024, 1, 6, 4))
        for now in (dt.datetime(2024, 1, 8, 5), dt.datetime(2024, 1, 9, 5), dt.datetime(2024, 1, 9, 13)):
            assert create_trips(state, now.date(), now) == 1
            if now.day == 8:  # another crew for a plan that has trips, and one taken off a trip
                trips = state.read("trips").where("not is_deleted").orderBy("id").limit(1)
                state.write("crew", {"crew_plans": trips.select("plan_id", F.lit(777).cast("bigint").alias("crew_id"))})
        made.append(state)
    whole, kept = made
    for name in ("trips", "stops", "stop_summaries", "trip_summaries", "trip_texts", "crew_trips", "plans"):
        assert image(kept, name) == image(whole, name), name
    clock = kept.read("creation_clock").first()
    assert clock["made"] == kept.read("trips").count() and clock["as_of"] == dt.datetime(2024, 1, 9, 13)
    assert kept.read("crew_trips").where("crew_id = 777").count() > 0
    want = started_trips_of_plans(kept.read("trips"), clock["as_of"])
    assert as_rows(kept.read("plan_trip_counts"), *want.columns) == as_rows(want, *want.columns)


def test_positions_carried_over_join_two_batches(spark):
    """Two batches that carry positions drive as far as one; without, the segments over the border are lost."""
    locations = cut_lineage(Batch(DerivedFleet(spark, SF_DIR)).locations)
    border = locations.select(F.percentile_approx("movement_time", 0.5)).first()[0]
    early = F.col("movement_time") <= F.lit(str(border)).cast("timestamp_ntz")
    none = spark.createDataFrame([], sweeping.LAST_POSITION)
    sums = lambda *frames: {
        tuple(r)[:2]: round(r.m, 6)
        for r in frames[0].unionByName(frames[-1]).groupBy("stop_summary_id", "vehicle_type").agg((F.sum("gps_metres") / (3 - len(frames))).alias("m")).collect()
        if r.m
    }
    whole = sweeping.driven_streets(locations)
    first = sweeping.driven_streets(locations.where(early), before=none)
    kept = cut_lineage(sweeping.last_positions(locations.where(early), none))
    second = sweeping.driven_streets(locations.where(~early), before=kept)
    assert sums(first, second) == sums(whole)
    assert sums(first, sweeping.driven_streets(locations.where(~early))) != sums(whole)
    after = as_rows(sweeping.last_positions(locations.where(~early), kept).unionByName(kept.join(locations.where(~early).select("vehicle_id"), "vehicle_id", "left_anti")), "vehicle_id", "movement_time", "longitude", "latitude")
    assert after == as_rows(sweeping.last_positions(locations, none), "vehicle_id", "movement_time", "longitude", "latitude")


def test_the_stream_carries_positions_when_asked(spark, tmp_path):
    fleet = DerivedFleet(spark, SF_DIR)
    state = StateTables(spark, str(tmp_path / "state"))
    first_fill(state, "load", {name: getattr(fleet, name) for name in TABLES if name not in SCRATCH})
    for day in (3, 4):
        pings = fleet.pings.where(f"to_date(movement_time) = date '2024-01-0{day}'")
        assert apply_batch(state, pings, f"day-{day}", choices=Choices(carry_positions=True)) == 1
    assert state.read("last_positions").count() > 0
