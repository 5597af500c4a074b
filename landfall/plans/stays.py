"""Questions about stays in time: weather before arrival, periods met, who is present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.lookups import left_lookup
from landfall.operators.temporal import asof_join, interval_join, present_per_day
from landfall.plans.edges import temperature_by


def arrival_cities(arrivals: DataFrame, airports: DataFrame) -> DataFrame:
    """Arrivals with the city of their airport; one row each (see `one_airport_per_code`)."""
    cities = airports.select("airport_code", F.col("municipality").alias("city"))
    return left_lookup(arrivals, cities, [("airport_code", "airport_code")])


def weather_before_arrival(
    arrivals: DataFrame, temperature: DataFrame, within: int | None = None
) -> DataFrame:
    """Arrivals (arrival_date, city) with their city's mean temperature on the last day up to
    then that has a reading, at most `within` days before.

    Adds `reading_day`, `avg_temperature` and the number of `readings`; NULL where there is
    none.
    """
    daily = temperature_by(temperature, "day").withColumnsRenamed({"city": "town", "day": "reading_day"})
    return asof_join(arrivals, daily, ("arrival_date", "reading_day"), [("city", "town")], within=within)


def with_departure(arrivals: DataFrame) -> DataFrame:
    """Arrivals with `departure_date`; NULL where the length of the stay is not known."""
    days = F.col("stay_duration").cast("int")
    return arrivals.withColumn("departure_date", F.date_add("arrival_date", days))


def stays_in_periods(
    arrivals: DataFrame,
    periods: DataFrame,
    on: Sequence[tuple[str, str]] = (),
    span: tuple[str, str] = ("first_day", "last_day"),
) -> DataFrame:
    """Each stay with each dated period that it meets, and the number of days they share."""
    met = interval_join(with_departure(arrivals), periods, ("arrival_date", "departure_date"), span, on)
    shared = F.datediff(F.least("departure_date", span[1]), F.greatest("arrival_date", span[0])) + 1
    return met.withColumn("shared_days", shared)


def visitors_present(arrivals: DataFrame, keys: Sequence[str] = ("airport_code",)) -> DataFrame:
    """The visitors present per key on each day from the first arrival to the last departure."""
    return present_per_day(with_departure(arrivals), "arrival_date", "departure_date", keys)
