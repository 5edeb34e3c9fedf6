"""Matching of tag reads: ends of the windows, one case per read, hot tags and vehicles."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from curbflow.functions.text import tag_key
from curbflow.plans import matching

S, E = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 18)


def run(spark, reads, trips, stops, summaries=None):
    """reads: (id, vehicle, tag, time); trips: (id, vehicle, start, end, deleted); stops: (id, trip, tag)."""
    lifts = spark.createDataFrame(reads, "id long, vehicle_id long, tag string, movement_time timestamp_ntz")
    lifts = lifts.withColumn("tag_key", tag_key(F.col("tag")))
    trips = spark.createDataFrame(
        trips, "id long, vehicle_id long, start_trip timestamp_ntz, end_trip timestamp_ntz, is_deleted boolean"
    )
    summaries = [(n * 10, n) for n, _, _ in stops] if summaries is None else summaries
    stops = spark.createDataFrame(stops, "id long, trip_id long, tag string")
    summaries = spark.createDataFrame(summaries, "id long, stop_id long")
    hits = matching.tag_hits(lifts, stops, trips)
    rows = matching.match_lifts(lifts, hits, trips, summaries).collect()
    return {(r.ping_id, r.case_no, r.trip_id, r.stop_id, r.summary_id) for r in rows}


TRIP = (1, 7, S, E, False)


@pytest.mark.parametrize(
    ("moment", "on_plan", "off_plan", "other"),
    [
        (S - dt.timedelta(seconds=1), None, None, None),
        (S, 1, 3, 5),
        (E - dt.timedelta(seconds=1), 1, 3, 5),
        # At the very end only the on-plan case holds; no trip is running and none has ended.
        (E, 1, None, None),
        (E + dt.timedelta(seconds=1), 2, 4, 6),
    ],
)
def test_ends_of_the_window(spark, moment, on_plan, off_plan, other):
    stops = [(11, 1, "PLANNED"), (12, 2, "ELSEWHERE")]
    trips = [TRIP, (2, 8, S, E, True)]
    reads = [(1, 7, "planned ", moment), (2, 7, "ELSEWHERE", moment)]
    got = {ping: case for ping, case, *_ in run(spark, reads, trips, stops)}
    assert got.get(1) == on_plan
    assert got.get(2) == off_plan
    got = {ping: case for ping, case, *_ in run(spark, [(3, 9, "PLANNED", moment)], trips, stops)}
    assert got.get(3) == other


def test_unplanned_and_nothing(spark):
    reads = [(1, 9, "NEW", S), (2, 9, "OLD", S)]
    # The only stop with OLD is on a deleted trip: planned, yet no case takes it.
    assert run(spark, reads, [(1, 7, S, E, True)], [(11, 1, "OLD")]) == {(1, 7, None, None, None)}


def test_late_stop_without_summary_falls_through(spark):
    late = E + dt.timedelta(hours=1)
    trips = [TRIP, (2, 7, S - dt.timedelta(days=1), E - dt.timedelta(days=1), False)]
    stops = [(11, 1, "A"), (12, 2, "A")]
    # The latest ended trip is chosen first; its stop has no summary, so case 2 does not take the read.
    assert run(spark, [(1, 7, "A", late)], trips, stops, summaries=[(120, 12)]) == set()
    assert run(spark, [(1, 7, "A", late)], trips, stops, summaries=[(110, 11)]) == {(1, 2, 1, 11, 110)}


def test_every_summary_on_plan(spark):
    got = run(spark, [(1, 7, "A", S)], [TRIP], [(11, 1, "A")], summaries=[(110, 11), (111, 11)])
    assert got == {(1, 1, 1, 11, 110), (1, 1, 1, 11, 111)}


def test_latest_start_then_greatest_id(spark):
    later = S + dt.timedelta(hours=2)
    trips = [TRIP, (2, 7, later, E, False), (3, 7, later, E, False)]
    got = run(spark, [(1, 7, "NEW", S + dt.timedelta(hours=3))], trips, [(11, 1, "A")])
    assert got == {(1, 3, 3, None, None)}


def brute(reads, trips, stops):
    """The cascade read by read."""
    live = {t[0]: t for t in trips if not t[4]}
    out = {}
    for ping, vehicle, tag, at in reads:
        here = [(n, live[t]) for n, t, name in stops if name == tag and t in live]
        with_tag = {t for _, t, name in stops if name == tag}
        mine = [(n, t) for n, t in here if t[1] == vehicle]
        theirs = [(n, t) for n, t in here if t[1] != vehicle]
        inside = [t for t in live.values() if t[1] == vehicle and t[2] <= at < t[3]]
        ended = [t for t in live.values() if t[1] == vehicle and t[3] < at]
        pick3 = max(inside, key=lambda t: (t[2], t[0]), default=None)
        pick4 = max(ended, key=lambda t: (t[3], t[0]), default=None)
        if any(t[2] <= at <= t[3] for _, t in mine):
            out[ping] = 1
        elif any(t[3] < at for _, t in mine):
            out[ping] = 2
        elif pick3 and pick3[0] not in with_tag:
            out[ping] = 3
        elif pick4 and pick4[0] not in with_tag:
            out[ping] = 4
        elif any(t[2] <= at < t[3] for _, t in theirs):
            out[ping] = 5
        elif any(t[3] < at for _, t in theirs):
            out[ping] = 6
        elif not with_tag:
            out[ping] = 7
    return out


def test_hot_tag_and_hot_vehicle(spark):
    rng = random.Random(9)
    hour = lambda n: S + dt.timedelta(hours=n)
    trips = []
    for n in range(120):
        start = rng.randrange(0, 400)
        vehicle = 1 if rng.random() < 0.5 else rng.randrange(2, 9)
        trips.append((n, vehicle, hour(start), hour(start + rng.choice([4, 12])), rng.random() < 0.1))
    tags = ["HOT"] + [f"T{n}" for n in range(40)]
    stops = [(n, rng.randrange(130), "HOT" if rng.random() < 0.4 else rng.choice(tags)) for n in range(600)]
    reads = [(n, 1 if rng.random() < 0.5 else rng.randrange(2, 11), tag, hour(rng.randrange(-10, 420))) for n, tag in enumerate([*tags, *(f"N{n}" for n in range(60))])]
    got = run(spark, reads, trips, stops)
    cases = {}
    for ping, case, *_ in got:
        assert cases.setdefault(ping, case) == case
    assert cases == brute(reads, trips, stops)
