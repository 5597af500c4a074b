"""Operators along time against plain Python, and the plans they make."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import final_plan_of, plan_of
from landfall.operators import asof_join, interval_join, present_per_day, temporal
from landfall.plans import weather_before_arrival

DAY = dt.date(2016, 1, 1)


def day(number):
    return DAY + dt.timedelta(number)


def left_rows(rng, n, spread=4000):
    return [
        (i, rng.choice(["a", "b", "c", None]), day(rng.randrange(spread)) if rng.random() > 0.05 else None)
        for i in range(n)
    ]


def right_rows(rng, n, spread=4000):
    return [
        (rng.choice(["a", "b", None]), day(rng.randrange(-10, spread)), rng.choice([None, 1.0, 2.0]))
        for _ in range(n)
    ]


def frames_of(spark, left, right):
    return (
        spark.createDataFrame(left, "id int, city string, day date"),
        spark.createDataFrame(right, "town string, dt date, temp double"),
    )


def low(value):
    return (value is not None, value or 0)


def search(left, right, fits, nearest):
    """For each left id the right (dt, temp), found by looking at all right rows."""
    found = {}
    for i, city, on in left:
        mine = [(t, low(v), v) for town, t, v in right if None not in (city, on) and town == city and fits(on, t)]
        best = nearest(mine, key=lambda m: m[0]) if mine else None
        ties = [m for m in mine if best and m[0] == best[0]]
        found[i] = (best[0], max(ties, key=lambda m: m[1])[2]) if best else (None, None)
    return found


def asof(left, right, **options):
    joined = asof_join(left, right, ("day", "dt"), [("city", "town")], **options)
    return {r.id: (r.dt, r.temp) for r in joined.collect()}


@pytest.mark.parametrize("slice_width", [None, 7, 100])
def test_asof_finds_the_last_row_with_ties_and_gaps(spark, slice_width):
    rng = random.Random(1)
    left, right = left_rows(rng, 400), right_rows(rng, 60)
    right += right[:10]  # repeated rows
    a, b = frames_of(spark, left, right)
    assert asof(a, b, slice_width=slice_width) == search(left, right, lambda on, t: t <= on, max)


def test_asof_forward_strict_and_within(spark):
    rng = random.Random(2)
    left, right = left_rows(rng, 300, 300), right_rows(rng, 60, 300)
    a, b = frames_of(spark, left, right)
    got = asof(a, b, direction="forward", slice_width=16)
    assert got == search(left, right, lambda on, t: t >= on, min)
    got = asof(a, b, exact=False, slice_width=16)
    assert got == search(left, right, lambda on, t: t < on, max)
    got = asof(a, b, within=2, slice_width=16)
    near = search(left, right, lambda on, t: t <= on, max)
    days = {i: on for i, _, on in left}
    assert got == {
        i: found if found[0] and (days[i] - found[0]).days <= 2 else (None, None) for i, found in near.items()
    }


def test_asof_of_empty_sides_and_without_keys(spark):
    rng = random.Random(3)
    left, right = left_rows(rng, 50), right_rows(rng, 20)
    a, b = frames_of(spark, left, right)
    assert set(asof(a, b.where("false")).values()) == {(None, None)}
    assert asof(a.where("false"), b) == {}
    joined = asof_join(a, b, ("day", "dt"), values=["dt"]).collect()
    times = [t for _, t, _ in right]
    assert {r.id: r.dt for r in joined} == {
        i: max((t for t in times if t <= on), default=None) if on else None for i, _, on in left
    }


def test_asof_on_timestamps(spark):
    stamp = dt.datetime(2020, 1, 1)
    left = spark.createDataFrame([(i, stamp + dt.timedelta(hours=5 * i)) for i in range(9)], "id int, ts timestamp")
    right = spark.createDataFrame([(stamp + dt.timedelta(hours=h), h) for h in (1, 11, 12)], "at timestamp, h int")
    found = asof_join(left, right, ("ts", "at"), values=["h"], within=7200).collect()
    exact = {i: max((h for h in (1, 11, 12) if h <= 5 * i and 5 * i - h <= 2), default=None) for i in range(9)}
    assert {r.id: r.h for r in found} == exact


def test_asof_rejects_what_it_cannot_compare(spark):
    a, b = frames_of(spark, [(1, "a", DAY)], [("a", DAY, 1.0)])
    with pytest.raises(ValueError, match="direction"):
        asof_join(a, b, ("day", "dt"), direction="nearest")
    with pytest.raises(TypeError, match="day is date"):
        asof_join(a, b.withColumn("dt", F.col("dt").cast("timestamp")), ("day", "dt"))
    with pytest.raises(ValueError, match="both sides: city"):
        asof_join(a, b.withColumn("city", F.lit(1)), ("day", "dt"), [("city", "town")])
    with pytest.raises(TypeError, match="whole numbers"):
        asof_join(a.withColumn("day", F.lit(1.0)), b.withColumn("dt", F.lit(1.0)), ("day", "dt"))


def test_a_hot_city_is_cut_into_slices(spark, settings):
    """One city with all rows: its years are sorted in several tasks, not in one."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left = spark.range(8000).selectExpr("id", "'x' as city", "date_add(date'2000-01-01', int(id)) as day")
    right = left.selectExpr("city as town", "day as dt", "double(id) as temp").where("id % 10 = 0")
    joined = asof_join(left, right, ("day", "dt"), [("city", "town")])
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    scans = [line for line in plan.splitlines() if "Exchange hashpartitioning(__key_0" in line]
    assert any("__slice" in line for line in scans)
    assert joined.where("temp != id - id % 10").count() == 0
    slices = left.select(temporal._slice(F.col("day"), left.schema["day"].dataType, None)).distinct().count()
    assert slices > 7


def intervals(rng, n, lengths, spread=900):
    rows = []
    for i in range(n):
        start = rng.randrange(spread)
        end = day(start + rng.choice(lengths))
        rows.append((i, rng.choice(["a", "b", None]), day(start) if rng.random() > 0.05 else None, end))
    return rows


def overlapping(left, right):
    return sorted(
        (x[0], y[0]) for x in left for y in right
        if x[1] is not None and x[1] == y[1] and None not in (x[2], y[2])
        and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    )


def spans(spark, left, right):
    return (
        spark.createDataFrame(left, "i int, k string, s date, e date"),
        spark.createDataFrame(right, "j int, k2 string, f date, t date"),
    )


def test_overlapping_periods_are_found_once(spark):
    rng = random.Random(4)
    left = intervals(rng, 250, [0, 1, 5, 30, 700, -2])
    right = intervals(rng, 60, [0, 6, 29, 364, -1])
    a, b = spans(spark, left, right)
    found = interval_join(a, b, ("s", "e"), ("f", "t"), [("k", "k2")])
    assert found.columns == ["i", "k", "s", "e", "j", "f", "t"]
    assert sorted((r.i, r.j) for r in found.collect()) == overlapping(left, right)


def test_points_in_periods_equal_between(spark):
    rng = random.Random(5)
    left = [(i, k, s, s) for i, k, s, _ in intervals(rng, 200, [0])]
    right = intervals(rng, 40, [0, 3, 80])
    a, b = spans(spark, left, right)
    found = interval_join(a.drop("e"), b, ("s", "s"), ("f", "t"), [("k", "k2")]).collect()
    assert sorted((r.i, r.j) for r in found) == overlapping(left, right)
    assert interval_join(a.where("false"), b, ("s", "e"), ("f", "t")).collect() == []
    assert interval_join(a, b.where("false"), ("s", "e"), ("f", "t")).collect() == []


def test_a_stay_of_years_does_not_multiply_rows(spark):
    """However long, a period takes two rows of its own and two per level of the other side."""
    stays = spark.createDataFrame([(i, "a", DAY, day(4000 + i)) for i in range(50)], "i int, k string, s date, e date")
    short = spark.createDataFrame([(j, "a", day(j), day(j + 2)) for j in range(30)], "j int, k2 string, f date, t date")
    a, b = temporal._with_level(stays, "s", "e", "a"), temporal._with_level(short, "f", "t", "b")
    levels = temporal._levels(b, "b")
    assert temporal._bins(a, "a").count() <= 100
    assert temporal._bins(a, "a", levels).count() == 0
    assert temporal._bins(b, "b", temporal._levels(a, "a")).count() <= 60
    joined = interval_join(stays, short, ("s", "e"), ("f", "t"), [("k", "k2")])
    plan = final_plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() == 1500


def present(rows):
    counts, ends = Counter(), {}
    for _, k, s, e in rows:
        if s is None or e is None or e < s:
            continue
        lo, hi = ends.get(k, (s, e))
        ends[k] = (min(lo, s), max(hi, e))
        for n in range((e - s).days + 1):
            counts[k, s + dt.timedelta(n)] += 1
    return {
        (k, d): counts[k, d]
        for k, (lo, hi) in ends.items()
        for d in (lo + dt.timedelta(n) for n in range((hi - lo).days + 1))
    }


@pytest.mark.parametrize("units", [16, 1024])
def test_present_per_day_counts_every_day(spark, monkeypatch, units):
    monkeypatch.setattr(temporal, "SLICE_UNITS", units)
    rows = intervals(random.Random(6), 150, [0, 1, 5, 30, -2], spread=3000)
    df = spark.createDataFrame(rows, "i int, k string, s date, e date")
    found = present_per_day(df, "s", "e", ["k"]).collect()
    assert {(r.k, r.day): r.present for r in found} == present(rows) and len(found) == len(present(rows))
    alone = present_per_day(df, "s", "e").collect()
    flat = present([(i, 0, s, e) for i, _, s, e in rows])
    assert {(0, r.day): r.present for r in alone} == flat
    assert present_per_day(df.where("false"), "s", "e", ["k"]).collect() == []


def test_weather_before_arrival_averages_a_day(spark):
    arrivals = spark.createDataFrame([(1, DAY, "x"), (2, day(-9), "x"), (3, DAY, None)], "id int, arrival_date date, city string")
    readings = spark.createDataFrame([("2015-12-30", 1.0, "x"), ("2015-12-30", 2.0, "x")], "dt string, avg_temperature double, city string")
    found = {r.id: (r.reading_day, r.avg_temperature, r.readings) for r in weather_before_arrival(arrivals, readings).collect()}
    assert found == {1: (day(-2), 1.5, 2), 2: (None, None, None), 3: (None, None, None)}
