"""Subtotals, and sketches that are stored per month and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import (
    SketchSpec,
    cube_sets,
    merge_sketches,
    overlap_estimate,
    rollup_sets,
    sketch_by,
    sketch_estimates,
)
from landfall.operators import subtotals as subtotals_of
from landfall.sinks import publish_table, read_snapshot
from landfall.workloads import frames
from landfall.workloads.registry import load, query, scratch

_MEASURES = {
    "arrivals": ("count", None),
    "with_stay": ("count", "stay_duration"),
    "days": ("sum", "stay_duration"),
    "avg_days": ("avg", "stay_duration"),
    "longest": ("max", "stay_duration"),
}
_MEASURES_SQL = """
count(*) as arrivals, count(stay_duration) as with_stay, sum(stay_duration) as days,
avg(stay_duration) as avg_days, max(stay_duration) as longest"""


@query(f"""
with {frames.ARRIVALS}
select month, visacode, address, grouping_id(month, visacode, address) as level, {_MEASURES_SQL}
from arrivals group by grouping sets ((month, visacode, address), (month, visacode), (month), (address), ())""")
def subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month, visa and address in several sets; the missing address and a subtotal differ."""
    sets = [("month", "visacode", "address"), ("month", "visacode"), ("month",), ("address",), ()]
    return subtotals_of(frames.arrivals(spark, sf_dir), sets, _MEASURES)


@query(f"""
with {frames.ARRIVALS}
select year, month, address, grouping_id(year, month, address) as level, {_MEASURES_SQL}
from arrivals group by rollup (year, month, address)""")
def subtotals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, their months, and these by address."""
    return subtotals_of(frames.arrivals(spark, sf_dir), rollup_sets(["year", "month", "address"]), _MEASURES)


@query(f"""
with {frames.ARRIVALS}
select visacode, address, month, grouping_id(visacode, address, month) as level, {_MEASURES_SQL}
from arrivals group by cube (visacode, address, month)""")
def subtotals_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every selection of three keys."""
    return subtotals_of(frames.arrivals(spark, sf_dir), cube_sets(["visacode", "address", "month"]), _MEASURES)


_SPEC = SketchSpec(distinct=["airport_code"], overlap=["airport_code"], quantiles=["stay_duration"])


def _stored_states(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """States per month, published as a table; the last year of them is refreshed on its own."""
    path = scratch(spark, label)
    arrivals = frames.arrivals(spark, sf_dir)
    publish_table(sketch_by(arrivals, ["year", "month"], _SPEC), path, ["year"])
    again = sketch_by(arrivals.where("year = 1998"), ["year", "month"], _SPEC)
    publish_table(again, path, ["year"], mode="partitions")
    return read_snapshot(spark, path)


@query(f"""
with {frames.ARRIVALS}
select year, count(*) as rows, count(distinct airport_code) as ports, true as close
from arrivals group by 1""")
def distinct_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports per year from the states of its months, and whether they are within three
    standard errors of the exact number."""
    merged = merge_sketches(_stored_states(spark, sf_dir, "distinct_sketches"), ["year"], _SPEC)
    found = sketch_estimates(merged, _SPEC).select(F.col("year").alias("y"), "rows", "distinct_airport_code")
    exact = frames.arrivals(spark, sf_dir).groupBy("year").agg(F.count_distinct("airport_code").alias("ports"))
    off = F.abs(F.col("distinct_airport_code") - F.col("ports"))
    close = off <= F.greatest(F.lit(1.0), F.col("ports") * _SPEC.distinct_error)
    return exact.join(found, F.col("year") == F.col("y")).select("year", "rows", "ports", close.alias("close"))


@query(f"""
with {frames.ARRIVALS}
select month, count(stay_duration) as stays, true as close from arrivals group by 1""")
def median_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median stay per month over all years, and whether its rank is within the bound."""
    states = _stored_states(spark, sf_dir, "median_sketches")
    found = sketch_estimates(merge_sketches(states, ["month"], _SPEC), _SPEC).select(
        F.col("month").alias("m"), "q50_stay_duration"
    )
    stays = frames.arrivals(spark, sf_dir).where("stay_duration IS NOT NULL")
    met = stays.join(found, F.col("month") == F.col("m"))
    value, all_rows = F.col("stay_duration"), F.count(F.lit(1))
    below = F.count_if(value < F.col("q50_stay_duration")) / all_rows
    up_to = F.count_if(value <= F.col("q50_stay_duration")) / all_rows
    close = (below <= 0.5 + _SPEC.rank_error) & (up_to >= 0.5 - _SPEC.rank_error)
    return met.groupBy("month").agg(all_rows.alias("stays"), close.alias("close"))


@query(f"""
with {frames.ARRIVALS},
both_years as (select airport_code from arrivals where year = 1996
               intersect select airport_code from arrivals where year = 1997)
select count(*) as ports, true as close from both_years""")
def shared_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports with arrivals in both of two years, from the states of their months."""
    states = _stored_states(spark, sf_dir, "shared_sketches")
    shared = overlap_estimate(states, "airport_code", F.col("year") == 1996, F.col("year") == 1997)
    arrivals = frames.arrivals(spark, sf_dir).where("year IN (1996, 1997)")
    per_port = arrivals.groupBy("airport_code").agg(F.count_distinct("year").alias("years"))
    exact = per_port.agg(F.count_if(F.col("years") == 2).alias("ports"))
    both = exact.unionByName(shared, allowMissingColumns=True).agg(
        F.max("ports").alias("ports"), F.max("shared").alias("shared")
    )
    # An intersection's error is that of the larger side.
    close = F.abs(F.col("shared") - F.col("ports")) <= F.greatest(F.lit(1.0), F.col("ports") * 2 * _SPEC.distinct_error)
    return both.select("ports", close.alias("close"))
