"""Extracts taken one by one against the same extracts in one go."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall.plans import conform_arrivals
from landfall.streaming import arrival_windows, conform_arrivals_stream, run_available, stream_extracts

SCHEMA = (
    "cicid double, i94yr double, i94mon double, i94port string, i94addr string, i94mode double, i94visa double,"
    " i94bir double, arrdate double, depdate double, biryear double, gender string, visatype string, admnum long"
)
EPOCH = dt.date(1960, 1, 1)
FIRST = (dt.date(2016, 1, 1) - EPOCH).days


def arrivals(rng, first, days, n):
    found = []
    for i in range(n):
        on = first + rng.randrange(days)
        day = EPOCH + dt.timedelta(on)
        found.append((
            float(i), float(day.year), float(day.month), rng.choice(["NYC", "LAX", None]), "CA", rng.choice([1.0, 1.0, 2.0, None]),
            1.0, rng.choice([30.0, 40.0, None]), float(on), rng.choice([None, on + 5.0]), 1980.0, "F", "B1", rng.randrange(5),
        ))
    return found


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "table", "state")}


def put(spark, place, found):
    spark.createDataFrame(found, SCHEMA).write.mode("append").parquet(place["raw"])


def take(spark, place, plan, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return run_available(plan(stream_extracts(spark, place["raw"], schema, **options)), place["table"], place["state"])


def test_micro_batches_and_restarts_give_the_batch_result(spark, place):
    rng = random.Random(1)
    whole = []
    for month in range(3):
        extract = arrivals(rng, FIRST + 30 * month, 30, 60)
        # Copies within an extract, and of rows of the extract before.
        extract += extract[:10] + whole[-20:]
        whole += extract
        put(spark, place, extract[:40])
        put(spark, place, extract[40:])
        take(spark, place, lambda raw: conform_arrivals_stream(raw, "90 days", True), files_per_batch=1)
    batch = conform_arrivals(spark.createDataFrame(whole, SCHEMA), keep_arrival_date=True)
    streamed = spark.read.schema(batch.schema).parquet(place["table"])
    assert rows(streamed) == rows(batch)
    take(spark, place, lambda raw: conform_arrivals_stream(raw, "90 days", True))
    assert streamed.count() == batch.count()


def test_late_rows_are_left_out_and_state_is_freed(spark, place):
    rng = random.Random(2)
    put(spark, place, [(*r[:3], "NYC", "CA", 1.0, 1.0, 30.0, *r[8:]) for r in arrivals(rng, FIRST + 100, 10, 20)])
    take(spark, place, lambda raw: conform_arrivals_stream(raw, "20 days", True))
    before = spark.read.parquet(place["table"]).count()
    on_time, late = FIRST + 95.0, FIRST + 50.0
    fixed = (2016.0, 1.0, "NYC", "CA", 1.0, 1.0, 30.0)
    put(spark, place, [(1.0, *fixed, on_time, None, 1980.0, "F", "B1", 77), (1.0, *fixed, late, None, 1980.0, "F", "B1", 78)])
    query = take(spark, place, lambda raw: conform_arrivals_stream(raw, "20 days", True))
    found = spark.read.parquet(place["table"])
    assert found.count() == before + 1
    assert found.where(F.col("arrival_date") == EPOCH + dt.timedelta(int(on_time))).count() == 1
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1


def test_windows_are_given_out_once_they_are_closed(spark, place):
    rng = random.Random(3)
    whole = []
    for month in range(3):
        extract = arrivals(rng, FIRST + 30 * month, 30, 80)
        whole += extract + extract[:20]
        put(spark, place, extract + extract[:20])
        take(spark, place, lambda raw: arrival_windows(raw, "10 days"))
    facts = {r for r in whole if r[5] == 1.0 and None not in (r[3], r[7])}
    newest = EPOCH + dt.timedelta(int(max(r[8] for r in facts)))
    wanted = {}
    for r in facts:
        number = ((EPOCH + dt.timedelta(int(r[8]))) - dt.date(1970, 1, 1)).days // 7
        start = dt.date(1970, 1, 1) + dt.timedelta(7 * number)
        if start + dt.timedelta(7) <= newest - dt.timedelta(10):
            wanted[start, r[3]] = wanted.get((start, r[3]), 0) + 1
    found = spark.read.parquet(place["table"]).collect()
    assert {(r.window_start, r.i94port): r.arrivals for r in found} == wanted
    assert len(found) == len(wanted) > 10


def test_extracts_are_cut_to_the_contract(spark, place):
    put(spark, place, arrivals(random.Random(4), FIRST, 5, 5))
    schema = spark.createDataFrame([], SCHEMA + ", delete_me string").schema
    contract = [c for c in schema.fieldNames() if c != "delete_me"]
    stream = stream_extracts(spark, place["raw"], schema, contract=contract)
    assert stream.isStreaming and "delete_me" not in stream.columns
    with pytest.raises(ValueError, match="not found: nothing"):
        stream_extracts(spark, place["raw"], schema, contract=["nothing"])
