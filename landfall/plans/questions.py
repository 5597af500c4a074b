"""The questions the lake is there to answer.

Each one counts the fact table down to a few keys before it joins, so the joins move
keys, not arrivals.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import period_columns
from landfall.operators.aggregates import count_by, top_k
from landfall.operators.lookups import decode, left_lookup
from landfall.plans.edges import airport_demographics, decode_arrivals, temperature_by


def arrivals_by_month(arrivals: DataFrame) -> DataFrame:
    """Arrivals per year and month, heaviest first."""
    counted = count_by(arrivals, "year", "month", out="arrivals")
    return counted.orderBy(F.col("arrivals").desc(), "year", "month")


def top_ports(arrivals: DataFrame, port_codes: DataFrame, k: int = 10) -> DataFrame:
    """The k ports with the most arrivals, with their names."""
    busiest = top_k(arrivals, ["airport_code"], k, out="arrivals")
    named_ports = decode(busiest, "airport_code", port_codes, "port_name", "is_placeholder")
    return named_ports.orderBy(F.col("arrivals").desc(), "airport_code")


def decoded_arrivals(lake: Mapping[str, DataFrame]) -> DataFrame:
    """Every arrival with the texts of its codes."""
    return decode_arrivals(lake["immigration"], lake)


def airport_city_profile(lake: Mapping[str, DataFrame], match_state: bool = True) -> DataFrame:
    """Airports of arrival with their number of arrivals, mean stay and city."""
    per_port = (
        lake["immigration"]
        .groupBy("airport_code")
        .agg(
            F.count(F.lit(1)).alias("arrivals"),
            F.round(F.avg("stay_duration"), 6).alias("avg_stay"),
        )
    )
    located = left_lookup(per_port, lake["airport_codes"], [("airport_code", "airport_code")])
    return airport_demographics(located, lake["demographics"], match_state).select(
        "airport_code",
        "arrivals",
        "avg_stay",
        "airport_name",
        "municipality",
        "iso_region",
        "population",
        "median_age",
        "foreign_born",
    )


def weather_at_peaks(
    arrivals: DataFrame,
    airports: DataFrame,
    temperature: DataFrame,
    k: int = 10,
    grain: str = "month",
) -> DataFrame:
    """The k busiest (port, period) pairs, with the average temperature there and then.

    All pairs are ranked, also those of ports without a known airport; only then are the
    city and its weather joined, so an unknown city leaves NULL. A code listed for airports
    in several cities gives a row for each. Grain "month" and "year_month" use the fact
    table's own columns; "day" and "day_of_month" need `arrival_date` (see
    `conform_arrivals(keep_arrival_date=True)`).
    """
    if "arrival_date" in arrivals.columns:
        periods = period_columns(F.col("arrival_date"), grain)
        arrivals = arrivals.drop(*periods).withColumns(periods)
    else:
        periods = period_columns(F.lit(None).cast("date"), grain)
        lacking = [name for name in periods if name not in arrivals.columns]
        if lacking:
            raise ValueError(f"grain {grain!r} needs an arrival_date column")
    peaks = top_k(arrivals, ["airport_code", *periods], k, out="arrivals")
    cities = airports.select("airport_code", F.col("municipality").alias("city")).distinct()
    located = left_lookup(peaks, cities, [("airport_code", "airport_code")])
    weather = temperature_by(temperature, grain)
    joined = left_lookup(located, weather, [("city", "city"), *[(p, p) for p in periods]])
    order = [F.col("arrivals").desc(), "airport_code", *periods, "city"]
    return joined.orderBy(*order)
