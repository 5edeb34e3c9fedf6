"""Skew-safe operators against plain Python, with one key holding most rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from curbflow.functions import geo, text, time
from curbflow.operators import consecutive_numbers, covering, first_per, last_before, near_lines, previous_row
from curbflow.operators.intervals import time_blocks
from curbflow.operators.nearby import cells_of_line, line_cells

T0 = dt.datetime(2024, 1, 1)


def moments(count, seed, span_hours=60):
    """(id, key, time); key 'hot' has about two thirds of the rows, times repeat."""
    rng = random.Random(seed)
    return [
        (i, "hot" if rng.random() < 0.66 else f"k{rng.randrange(5)}", T0 + dt.timedelta(minutes=rng.randrange(span_hours * 60)))
        for i in range(count)
    ]


def test_previous_row(spark):
    rows = moments(600, 1)
    df = spark.createDataFrame(rows, "id long, key string, at timestamp_ntz")
    got = {r.id: r.previous and r.previous.id for r in previous_row(df, "key", "at", ["id"], ["id"]).collect()}
    want, last = {}, {}
    for i, key, at in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        want[i] = last.get(key)
        last[key] = i
    assert got == want


def test_slices_do_not_follow_the_session_zone(spark):
    """The night the clocks go forward in New York, times without a zone still come in order."""
    night = dt.datetime(2024, 3, 10)
    rows = [(i, "k", night + dt.timedelta(minutes=7 * i)) for i in range(60)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(rows, "id long, key string, at timestamp_ntz")
        got = {r.id: r.previous and r.previous.id for r in previous_row(df, "key", "at", ["id"], ["id"]).collect()}
        gap = df.select(F.max(time.minutes_between(F.lit("2024-03-10").cast("timestamp_ntz"), F.col("at")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {i: i - 1 if i else None for i in range(60)}
    assert gap == 59 * 7


def test_last_before(spark):
    asks = moments(400, 2)
    marks = [(1000 + i, key, at) for i, key, at in moments(60, 3, span_hours=80)]
    left = spark.createDataFrame(asks, "ask long, key string, t timestamp_ntz")
    right = spark.createDataFrame(marks, "mark long, key string, e timestamp_ntz")
    got = {r.ask: r.mark for r in last_before(left, right, "key", "ask", "t", "mark", "e").collect()}
    want = {}
    for i, key, at in asks:
        earlier = [(e, m) for m, k, e in marks if k == key and e < at]
        if earlier:
            want[i] = max(earlier)[1]
    assert got == want


@pytest.mark.parametrize("closed", [False, True])
def test_covering(spark, closed):
    asks = moments(300, 4)
    spans = [(1000 + i, key, at, at + dt.timedelta(minutes=random.Random(i).choice([0, 30, 700, 3000]))) for i, key, at in moments(50, 5)]
    left = spark.createDataFrame(asks, "ask long, key string, t timestamp_ntz")
    right = spark.createDataFrame(spans, "span long, key string, s timestamp_ntz, e timestamp_ntz")
    joined = covering(left, right, "key", "t", "s", "e", closed_end=closed)
    got = sorted((r.ask, r.span) for r in joined.collect())
    want = sorted(
        (i, n) for i, key, at in asks for n, k, s, e in spans if k == key and s <= at and (at <= e if closed else at < e)
    )
    assert got == want


def test_time_blocks_cover_an_interval_once(spark):
    rng = random.Random(9)
    spans = [(0, 0), (0, 3), (0, 4), (-5, 5), (1, 5), (3, 3), (-70, -1), (4, 19), (15, 16), (0, 63), (0, 64)]
    spans += [(a, a + rng.choice([0, 1, 7, 30, 500])) for a in (rng.randrange(-2000, 2000) for _ in range(200))]
    df = spark.createDataFrame(spans, "first long, last long")
    for r in df.select("first", "last", time_blocks(F.col("first"), F.col("last")).alias("blocks")).collect():
        covered = sorted(s for b in r.blocks for s in range(b.block * 4**b.level, (b.block + 1) * 4**b.level))
        assert covered == list(range(r.first, r.last + 1))
        assert r.last - r.first >= 4 or {b.level for b in r.blocks} == {0}
    ages = spark.range(1).select(time_blocks(F.lit(118_000), F.lit(17_500_000)).alias("b")).first().b
    assert len(ages) <= 80 and sum(4**b.level for b in ages) == 17_500_000 - 118_000 + 1


def test_covering_with_a_trip_of_ages(spark):
    """An interval up to the year 9999 among usual ones, a hot key, and ends out of order or missing."""
    asks = moments(400, 14) + [(900, "hot", dt.datetime(8123, 4, 5)), (901, "hot", dt.datetime(1969, 12, 31, 23)), (902, "k1", None)]
    spans = [(1000 + i, key, at, at + dt.timedelta(hours=random.Random(i).choice([1, 30, 900]))) for i, key, at in moments(60, 15)]
    spans += [(2000, "hot", dt.datetime(2024, 1, 2), dt.datetime(9999, 12, 31)), (2001, "hot", dt.datetime(1960, 1, 1), dt.datetime(1990, 1, 1))]
    spans += [(2002, "hot", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 4)), (2003, "hot", None, dt.datetime(2024, 1, 4))]
    left = spark.createDataFrame(asks, "ask long, key string, t timestamp_ntz")
    right = spark.createDataFrame(spans, "span long, key string, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.ask, r.span) for r in covering(left, right, "key", "t", "s", "e").collect())
    assert got == sorted((i, n) for i, key, at in asks for n, k, s, e in spans if at and s and k == key and s <= at < e)
    assert {n for _, n in got} >= {2000, 2001}


def piece_distance(px, py, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    long = dx * dx + dy * dy
    t = 0 if long == 0 else max(0, min(1, ((px - a[0]) * dx + (py - a[1]) * dy) / long))
    return ((px - a[0] - t * dx) ** 2 + (py - a[1] - t * dy) ** 2) ** 0.5


def test_near_lines(spark):
    rng = random.Random(6)
    near = 0.0002
    spot = lambda: (39.2 + rng.random() * 0.01, 21.4 + rng.random() * 0.01)
    lines = [(i, [spot() for _ in range(rng.choice([1, 2, 3, 6]))]) for i in range(40)]
    lines.append((40, [(39.2, 21.401), (39.2, 21.409)]))  # upright
    lines.append((41, [(39.2, 21.405), (39.21, 21.405)]))  # level
    points = [(i, *spot()) for i in range(1500)]
    # A heap of points on one place, and points just beside a line.
    points += [(2000 + i, 39.205, 21.405 + (i % 7) * 0.00005) for i in range(500)]
    line_df = spark.createDataFrame(lines, "line_id long, line array<struct<lon: double, lat: double>>")
    point_df = spark.createDataFrame(points, "point long, lon double, lat double")
    joined = near_lines(point_df, line_cells(line_df, "line_id", "line", near), [], "lon", "lat", near).collect()
    got = {(r.point, r.line_id): r.distance for r in joined}
    assert len(got) == len(joined)
    want = {}
    for i, x, y in points:
        for n, path in lines:
            d = min(piece_distance(x, y, a, b) for a, b in zip(path, path[1:] or path))
            if d <= near:
                want[i, n] = d
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_a_stray_vertex_has_tens_of_cells(spark):
    near = 0.0002
    lines = [(0, [(39.2, 21.4), (39.2005, 21.4)]), (1, [(39.2, 21.4), (0.0, 0.0), (39.2005, 21.4)]), (2, [(39.2, 21.4), (39.25, 21.43)])]
    line_df = spark.createDataFrame(lines, "line_id long, line array<struct<lon: double, lat: double>>")
    sizes = {r.line_id: r.n for r in line_cells(line_df, "line_id", "line", near).groupBy("line_id").agg(F.count("*").alias("n")).collect()}
    assert sizes[1] < 60 and sizes[2] < 60 and sizes[0] < 10
    points = [(0, 39.2001, 21.40001), (1, 19.6, 10.7), (2, 39.225, 21.415), (3, 39.2003, 21.5)]
    point_df = spark.createDataFrame(points, "point long, lon double, lat double")
    got = {(r.point, r.line_id) for r in near_lines(point_df, line_cells(line_df, "line_id", "line", near), [], "lon", "lat", near).collect()}
    want = {(i, n) for i, x, y in points for n, path in lines if min(piece_distance(x, y, a, b) for a, b in zip(path, path[1:])) <= near}
    assert got == want and len(got) >= 4
    # Cells stored with the line are those worked out from it.
    stored = line_df.withColumn("cells", cells_of_line(F.col("line"), near)).withColumn("cells", F.when(F.col("line_id") != 2, F.col("cells")))
    rows = lambda df: sorted((r.line_id, r.level, r.cx, r.cy, sorted(r.pieces)) for r in df.collect())
    assert rows(line_cells(stored, "line_id", "line", near, "cells")) == rows(line_cells(line_df, "line_id", "line", near))


def test_first_per_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(moments(500, 7), "id long, key string, at timestamp_ntz").repartition(4)
    first = first_per(df, ["key"], [F.col("at"), F.col("id")])
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()
    assert first.count() == df.select("key").distinct().count()


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_consecutive_numbers(spark, keys):
    rows = moments(700, 8)
    df = spark.createDataFrame(rows, "id long, key string, at timestamp_ntz")
    got = {r.id: r.n for r in consecutive_numbers(df, ["at", "id"], "n", start=5, keys=keys).collect()}
    want, seen = {}, {}
    for i, key, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        group = key if keys else None
        want[i] = seen[group] = seen.get(group, 4) + 1
    assert got == want


def test_expressions(spark):
    row = spark.sql("select timestamp_ntz '2024-01-01 10:00:59' as a, timestamp_ntz '2024-01-01 11:00:00' as b, 'tag1  ' as tag")
    out = row.select(
        time.minutes_between(F.col("a"), F.col("b")).alias("minutes"),
        text.tag_key(F.col("tag")).alias("key"),
        text.tag_hash(F.lit("TAG1")).alias("hash"),
        geo.haversine_metres(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("none"),
        geo.haversine_metres(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("far"),
    ).first()
    import hashlib

    assert out.minutes == 60
    assert out.key == "TAG1"
    assert out.hash == hashlib.sha256("TAG1".encode("utf-16-le")).hexdigest()
    assert out.none is None
    assert out.far == pytest.approx(20015086.8, rel=1e-6)


@pytest.mark.parametrize(
    ("tag", "untagged", "usable"),
    [
        (None, True, False), ("-1", True, False), ("-1  ", True, False), ("   ", True, False), ("", True, False),
        ("A" * 30, False, True), ("A" * 30 + "  ", False, True), ("A" * 31, False, False), ("x", False, True),
    ],
)
def test_tag_classes(spark, tag, untagged, usable):
    df = spark.createDataFrame([(tag,)], "tag string")
    row = df.select(text.is_untagged(F.col("tag")), text.is_usable_tag(F.col("tag"))).first()
    assert tuple(row) == (untagged, usable)
