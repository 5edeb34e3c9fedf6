"""Small sweeping cases, one per rule: speed, ignition, window, cap, sides, sensors."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from curbflow.plans import repair, sweeping
from curbflow.plans.sweep_rules import CURRENT, LEGACY

A, B = (39.232216, 21.429121), (39.233500, 21.429935)
C, D = (39.235649, 21.431947), (39.236209, 21.432402)
START, END = dt.datetime(2026, 4, 19, 2), dt.datetime(2026, 4, 19, 6)

LOCATION = (
    "ping_id int, trip_summary_id string, vehicle_id string, company_id string, movement_time timestamp_ntz, longitude double, latitude double, "
    "input1 int, input2 int, input3 int, input4 int, speed int, ignition boolean, trip_id string, "
    "stop_summary_id string, vehicle_type int, company_type int, stop_order int, street_length double, "
    "street_weight double, total_distance double"
)


def sweep(spark, points, *, inputs=(0, 5, 5, 0), speed=15, ignition=True, kind=1, company=1, old=0.0, rules=LEGACY):
    rows = [
        (i, "ts", "v", "c", START + dt.timedelta(minutes=i), x, y, *inputs, speed, ignition, "t", "s", kind, company, 1, 1500.0, 65.0, old)
        for i, (x, y) in enumerate(points)
    ]
    result = sweeping.swept_streets(spark.createDataFrame(rows, LOCATION), rules).collect()
    assert len(result) == 1
    return result[0]


def test_all_valid(spark):
    row = sweep(spark, [A, B, C, D])
    assert row.valid_metres == pytest.approx(553.2203, abs=1e-3)
    assert row.completion == pytest.approx(36.8814, abs=1e-3)


@pytest.mark.parametrize(
    "change", [{"speed": 0}, {"speed": 30}, {"ignition": False}, {"inputs": (0, 5, 0, 0)}], ids=str
)
def test_nothing_counts(spark, change):
    row = sweep(spark, [A, B], **change)
    assert row.valid_metres == 0
    assert row.completion == 0


def test_slowest_speed_counts(spark):
    row = sweep(spark, [A, B], speed=1)
    assert row.valid_metres == pytest.approx(160.7980, abs=1e-3)
    assert row.completion == pytest.approx(10.7199, abs=1e-3)


def test_no_movement(spark):
    assert sweep(spark, [A, A]).valid_metres == 0


def test_over_full_is_capped_by_the_update_only(spark):
    points = [A, (39.234, 21.4305), C, (39.2372, 21.4334)]
    row = sweep(spark, points, old=1400.0)
    assert row.valid_metres == pytest.approx(702.3507, abs=1e-3)
    assert row.completion == pytest.approx(140.1567, abs=1e-3)
    after = update(spark, [(0.0, 1400.0)], [(row.valid_metres, row.completion)])
    assert after[0].completion_pct == 100


def test_batch_longer_than_street_is_full(spark):
    far = [A, (39.26, 21.45)]
    assert sweep(spark, far).completion == 100


@pytest.mark.parametrize(("company", "inputs"), [(1, (0, 5, 5, 0)), (3, (5, 5, 0, 0)), (3, (0, 0, 5, 5))])
def test_large_sweeper(spark, company, inputs):
    for rules in (LEGACY, CURRENT):
        row = sweep(spark, [A, B], kind=16, company=company, inputs=inputs, speed=10, rules=rules)
        assert row.valid_metres == pytest.approx(160.7980, abs=1e-3)


def test_sides_only_under_current_rules(spark):
    # Water (input 2) and brush (input 4) are on, but no side has both its inputs.
    inputs = (0, 5, 0, 5)
    assert sweep(spark, [A, B], kind=16, company=3, inputs=inputs, rules=CURRENT).valid_metres == 0
    assert sweep(spark, [A, B], kind=16, company=3, inputs=inputs, rules=LEGACY).valid_metres > 0


def test_current_rules_ignore_ignition_and_take_speed_30(spark):
    row = sweep(spark, [A, B], kind=16, speed=30, ignition=False, rules=CURRENT)
    assert row.valid_metres > 0


def update(spark, old, new):
    """Stop summaries (percent, metres) after streets (metres, percent)."""
    before = spark.createDataFrame(
        [(str(i), f"stop{i}", pct, metres, 1.0, 2.0, 3.0, False) for i, (pct, metres) in enumerate(old)],
        "id string, stop_id string, completion_pct double, total_distance double, brush_distance double, "
        "water_distance double, gps_distance double, is_swept boolean",
    )
    streets = spark.createDataFrame(
        [(str(i), 16, 1, metres, pct, 0.0, 9.0, metres) for i, (metres, pct) in enumerate(new)],
        "stop_summary_id string, vehicle_type int, company_type int, valid_metres double, completion double, "
        "brush_metres double, water_metres double, gps_metres double",
    )
    return sweeping.street_state(before, streets).orderBy("id").collect()


def test_distance_adds_up_and_percent_is_replaced(spark):
    once = update(spark, [(20.0, 300.0)], [(200.0, 35.0)])[0]
    assert (once.total_distance, once.completion_pct) == (500, 35)
    twice = update(spark, [(once.completion_pct, once.total_distance)], [(200.0, 35.0)])[0]
    assert (twice.total_distance, twice.completion_pct) == (700, 35)
    # Zero leaves the old brush metres, anything else replaces.
    assert (once.brush_distance, once.water_distance, once.is_swept) == (1.0, 9.0, True)


def test_zero_percent_keeps_the_old_one(spark):
    assert update(spark, [(20.0, 300.0)], [(0.0, 0.0)])[0].completion_pct == 20


@pytest.mark.parametrize(
    ("stops", "expected"),
    [([(80.0, 65.0), (40.0, 35.0)], 66.0), ([(100.0, 65.0), (100.0, 35.0)], 100.0), ([(50.0, 0.0)], 0.0)],
)
def test_trip_mean(spark, stops, expected):
    frame = spark.createDataFrame
    fleet = SimpleNamespace(
        trips=frame([("t", "p")], "id string, plan_id string"),
        trip_summaries=frame([("ts", "t")], "id string, trip_id string"),
        plans=frame([("p", "sv", "c", 2, 10.0)], "id string, service_id string, contract_id string, active_trips int, completion_pct double"),
        services=frame([("sv", "g")], "id string, group_id string"),
        stops=frame([(f"s{i}", "t", w) for i, (_, w) in enumerate(stops)], "id string, trip_id string, street_weight double"),
    )
    summaries = frame([(f"s{i}", pct) for i, (pct, _) in enumerate(stops)], "stop_id string, completion_pct double")
    streets = frame([("t", 12.0)], "trip_id string, valid_metres double")
    row = sweeping.swept_trips(streets, summaries, fleet).first()
    assert row.trip_pct == pytest.approx(expected)
    assert row.valid_metres == 12


def test_order_of_the_input_does_not_matter(spark):
    # Several pings of a vehicle at one moment on one street.
    spots = [A, B, C, D, A, C]
    rows = [
        (i, "ts", "v", "c", START + dt.timedelta(minutes=i // 3), x, y, 0, 5, 5, 0, 15, True, "t", "s", 1, 1, 1, 1500.0, 65.0, 0.0)
        for i, (x, y) in enumerate(spots)
    ]
    metres = {
        round(sweeping.swept_streets(spark.createDataFrame(shuffled, LOCATION).repartition(n), LEGACY).first().valid_metres, 6)
        for n, shuffled in ((1, rows), (1, rows[::-1]), (4, rows[3:] + rows[:3]))
    }
    assert len(metres) == 1


def test_repair_counts_once_per_summary_of_the_trip(spark):
    """One bin trip with two summaries and two lifted stops: expected and actual are 4."""
    frame = spark.createDataFrame
    fleet = SimpleNamespace(
        services=frame([(1, 1)], "id int, kind_id int"),
        service_geometry=frame([(1, 1)], "kind_id int, geometry_type int"),
        plans=frame([(1, 1)], "id int, service_id int"),
        trips=frame([(1, 1)], "id int, plan_id int"),
        trip_summaries=frame([(1, 1, 2, 2.0), (2, 1, 2, 2.0)], "id int, trip_id int, expected_coverage int, actual_coverage double"),
        stops=frame([(1, 1, 1), (2, 1, 2)], "id int, trip_id int, stop_order int"),
        stop_summaries=frame([(1, 2, 13, 1), (2, 2, 13, 1)], "stop_id int, bin_status int, status_lookup int, completion_type int"),
    )
    assert [tuple(r) for r in repair.fix_expected(fleet).collect()] == [(1, 4)]
    assert [tuple(r) for r in repair.fix_actual(fleet).collect()] == [(1, 4)]


@pytest.mark.parametrize(
    ("moment", "inside"),
    [(START - dt.timedelta(seconds=1), False), (START, True), (END - dt.timedelta(seconds=1), True), (END, False)],
)
def test_window(spark, moment, inside):
    from curbflow.operators import covering

    pings = spark.createDataFrame([("v", moment)], "vehicle_id string, movement_time timestamp_ntz")
    trips = spark.createDataFrame([("v", START, END)], "vehicle_id string, start_trip timestamp_ntz, end_trip timestamp_ntz")
    found = covering(pings, trips, "vehicle_id", "movement_time", "start_trip", "end_trip")
    assert found.count() == int(inside)


def test_first_ping_has_no_segment_but_starts_the_trip(spark):
    row = (START, "v", "c")
    points = [(1, "ts", row[1], row[2], START, *A, 0, 5, 5, 0, 15, True, "t", "s", 1, 1, 1, 1500.0, 65.0, 0.0)]
    totals = sweeping.driven_streets(spark.createDataFrame(points, LOCATION), LEGACY)
    assert totals.first().first_ping == START
    assert sweeping.street_distances(totals).count() == 0
    assert totals.select(F.sum("valid_metres")).first()[0] == 0
