"""From raw tables to lake tables. The order of the steps is part of the meaning:

* arrivals are de-duplicated over all raw columns, before the projection, since two
  travellers may agree in every column that is kept (filters on single rows commute
  with that);
* demographics are de-duplicated after the projection, because the rows that remain
  without the race columns are repeats by design.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import day_number_to_date, named, type_of
from landfall.operators.distinct import distinct_rows
from landfall.operators.profiling import StepCounter
from landfall.operators.quality import Check, at_least_two, no_nulls, not_empty, rules
from landfall.operators.shaping import (
    cast_columns,
    drop_missing,
    rename,
    since,
    with_duration,
)
from landfall.schemas import (
    AIRPORT_DROPPED,
    AIRPORT_RENAMES,
    ARRIVAL_COLUMNS,
    ARRIVAL_RENAMES,
    ARRIVAL_REQUIRED,
    ARRIVED_BY_AIR,
    DEMOGRAPHICS_CASTS,
    DEMOGRAPHICS_DROPPED,
    DEMOGRAPHICS_RENAMES,
    DEMOGRAPHICS_RULES,
    LAKE_SCHEMAS,
    TEMPERATURE_RENAMES,
)


def conform_arrivals(
    extracts: DataFrame,
    keep_arrival_date: bool = False,
    counter: StepCounter | None = None,
) -> DataFrame:
    """The fact table: people who came by plane, with the length of their stay.

    Both filters look at one row at a time, so they may run before the de-duplication and
    reach the scan; with a `counter` the steps keep their order. Every raw column is part
    of the key, so whole raw rows are shuffled, after copies are dropped in each map task.
    Year and month become integers, so that partitions read `month=1`, not `month=1.0`.
    """

    if counter is None:
        complete = distinct_rows(_complete(_by_air(extracts)))
    else:
        once = counter.mark("distinct", distinct_rows(counter.mark("read", extracts)))
        by_air = counter.mark("by_air", _by_air(once))
        complete = counter.mark("complete", _complete(by_air))
    renamed = rename(complete.select(*ARRIVAL_COLUMNS), ARRIVAL_RENAMES)
    timed = with_duration(renamed, "arrdate", "depdate", "stay_duration")
    if keep_arrival_date:
        timed = timed.withColumn("arrival_date", _arrival_date(timed))
    kept = timed.drop("depdate", "arrdate")
    return cast_columns(kept, {"year": "int", "month": "int"})


def _by_air(df: DataFrame) -> DataFrame:
    return df.where(F.col("i94mode") == ARRIVED_BY_AIR)


def _complete(df: DataFrame) -> DataFrame:
    return drop_missing(df, ARRIVAL_REQUIRED)


def _arrival_date(df: DataFrame):
    if isinstance(type_of(df, "arrdate"), T.NumericType):
        return day_number_to_date(named("arrdate"))
    return named("arrdate").cast("date")


def arrival_checks(df: DataFrame) -> list[Check]:
    """Checks for the fact table; a stay that ends before it begins is reported, not dropped."""
    stay = rules({"stay_not_negative": "stay_duration IS NULL OR stay_duration >= 0"})
    return [not_empty(), *no_nulls(df, ["year", "month", "airport_code"]), *stay]


def conform_temperature(
    raw: DataFrame,
    country: str = "United States",
    from_day: str | dt.date = "2000-01-01",
) -> DataFrame:
    """Complete readings of one country from one day on."""
    complete = drop_missing(raw)
    recent = since(complete.where(F.col("Country") == country), "dt", from_day)
    return rename(recent, TEMPERATURE_RENAMES)


def temperature_checks() -> list[Check]:
    """Not empty, several cities, several dates."""
    return [not_empty(), at_least_two("city"), at_least_two("dt")]


def conform_airports(raw: DataFrame) -> DataFrame:
    """Airports that have an IATA code."""
    coded = drop_missing(raw, ["iata_code"])
    renamed = rename(coded.drop(*AIRPORT_DROPPED), AIRPORT_RENAMES)
    return renamed.select(*LAKE_SCHEMAS["airport_codes"].fieldNames())


def airport_checks(df: DataFrame) -> list[Check]:
    """No airport without a name or a code."""
    return no_nulls(df, ["airport_name", "airport_code"])


def conform_demographics(raw: DataFrame) -> DataFrame:
    """One row per city and state, with whole numbers of people."""
    complete = drop_missing(raw)
    cities = distinct_rows(complete.drop(*DEMOGRAPHICS_DROPPED))
    return cast_columns(rename(cities, DEMOGRAPHICS_RENAMES), DEMOGRAPHICS_CASTS)


def demographics_checks() -> list[Check]:
    """The four row rules on population numbers."""
    return rules(DEMOGRAPHICS_RULES)


def code_map_checks(df: DataFrame) -> list[Check]:
    """Checks for a code map."""
    return [not_empty(), *no_nulls(df, ["key", "value"])]
