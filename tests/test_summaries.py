"""Subtotals against plain Python, and sketches against exact figures."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from landfall.operators import (
    SketchSpec,
    cube_sets,
    merge_sketches,
    overlap_estimate,
    rollup_sets,
    sketch_by,
    sketch_estimates,
    subtotals,
)

MEASURES = {"n": ("count", None), "known": ("count", "x"), "total": ("sum", "x"), "mean": ("avg", "x"), "low": ("min", "x"), "high": ("max", "x")}


def test_subtotals_keep_missing_keys_apart(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([1.0, 2.5, 4.0, None])) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, l int, x double")
    sets = [("k", "l"), ("l",), ()]
    wanted = []
    for chosen in sets:
        groups = defaultdict(list)
        for k, l, x in data:
            groups[tuple(v if name in chosen else None for name, v in (("k", k), ("l", l)))].append(x)
        level = sum(bit for name, bit in (("k", 2), ("l", 1)) if name not in chosen)
        for key, xs in groups.items():
            known = [x for x in xs if x is not None]
            figures = (sum(known), sum(known) / len(known), min(known), max(known)) if known else (None,) * 4
            wanted.append((*key, level, len(xs), len(known), *figures))
    assert rows(subtotals(df, sets, MEASURES)) == sorted(wanted, key=repr)
    assert plan_of(subtotals(df, sets, MEASURES)).count("Expand") == 1


def test_subtotals_of_nothing_and_without_keys(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, x double")
    assert rows(subtotals(df, [()], {"n": ("count", None)})) == [(0, 1)]
    assert rows(subtotals(df.where("false"), [()], {"n": ("count", None)})) == [(0, 0)]
    assert subtotals(df.where("false"), [("k",)], MEASURES).count() == 0
    with pytest.raises(ValueError, match="unknown measure 'median'"):
        subtotals(df, [("k",)], {"m": ("median", "x")})


def test_sets_of_keys():
    assert rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]
    assert cube_sets(["a", "b"]) == [("a", "b"), ("a",), ("b",), ()]


SPEC = SketchSpec(distinct=["v"], overlap=["v"], quantiles=["x"])


def facts(spark):
    """Twelve months; 40,000 values of which neighbouring months share half."""
    return spark.range(240_000).selectExpr(
        "int(id % 12) AS month", "(id DIV 12) % 20000 + (id % 12) * 10000 AS v",
        "double(pmod(hash(id), 1000)) AS x",
    )


def test_merged_states_answer_for_any_union_of_months(spark):
    df = facts(spark)
    states = sketch_by(df, ["month"], SPEC)
    exact = {r.half: r for r in df.groupBy((F.col("month") < 6).alias("half")).agg(F.count_distinct("v").alias("v"), F.median("x").alias("x")).collect()}
    merged = merge_sketches(states.withColumn("half", F.col("month") < 6), ["half"], SPEC)
    at_once = sketch_by(df.withColumn("half", F.col("month") < 6), ["half"], SPEC)
    direct = {r.half: r for r in sketch_estimates(at_once, SPEC).collect()}
    for r in sketch_estimates(merged, SPEC, ranks=(0.25, 0.5)).collect():
        assert r.rows == 120_000
        assert abs(r.distinct_v - exact[r.half].v) <= exact[r.half].v * SPEC.distinct_error
        assert abs(r.distinct_v - direct[r.half].distinct_v) <= exact[r.half].v * 0.01
        assert abs(r.q50_x - exact[r.half].x) <= 1000 * SPEC.rank_error
        assert abs(r.q25_x - 250) <= 1000 * SPEC.rank_error


def test_values_shared_by_two_sets_of_months(spark):
    states = sketch_by(facts(spark), ["month"], SPEC)
    shared = overlap_estimate(states, "v", F.col("month") == 3, F.col("month") == 4).first().shared
    assert abs(shared - 10_000) <= 2 * 10_000 * SPEC.distinct_error
    assert overlap_estimate(states, "v", F.col("month") == 1, F.col("month") == 9).first().shared == 0


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 7, float("nan")), (1, 7, None), (2, None, 3.0)], "month int, v long, x double")
    found = sketch_estimates(sketch_by(df, ["month"], SPEC), SPEC)
    assert rows(found) == [(1, 2, 1, None), (2, 1, 0, 3.0)]
    empty = sketch_by(df.where("false"), ["month"], SPEC)
    assert merge_sketches(empty, ["month"], SPEC).count() == 0
