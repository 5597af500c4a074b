"""Joins along the declared edges of the snowflake model.

City names alone are not keys: demographics repeat them per state and temperatures per
date. So temperatures are averaged to a grain before any join, and demographics are
matched on state as well unless the caller says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import period_columns, us_state_code
from landfall.operators.aggregates import average_by
from landfall.operators.distinct import one_per_key
from landfall.operators.lookups import decode, left_lookup
from landfall.operators.quality import duplicate_keys
from landfall.schemas import AIRPORT_TYPES


def temperature_by(
    temperature: DataFrame, grain: str | None = None, keys: Sequence[str] = ("city",)
) -> DataFrame:
    """Average temperature and number of readings per key and time grain."""
    periods = period_columns(F.col("dt"), grain) if grain else {}
    return average_by(
        temperature.withColumns(periods),
        [*keys, *periods],
        "avg_temperature",
        "avg_temperature",
        count_out="readings",
    )


def city_places(temperature: DataFrame) -> DataFrame:
    """Distinct places behind each city name. Where there are several, the averages of
    `temperature_by` blend cities that share a name."""
    place = F.struct("latitude", "longitude")
    return temperature.groupBy("city").agg(
        F.count_distinct(place).alias("places"), F.count(F.lit(1)).alias("readings")
    )


def _guarded(
    dimension: DataFrame, keys: Sequence[str], order: Sequence[Column], repeated: str
) -> DataFrame:
    """The dimension with each key once. One small job looks for repeated keys first: where
    there is none the table itself is joined, whose size Spark knows."""
    if repeated != "all":
        known = dimension.dropna(subset=list(keys))
        if duplicate_keys(known, keys).isEmpty():
            return dimension
    return one_per_key(dimension, keys, order, repeated)


def one_airport_per_code(airports: DataFrame, repeated: str = "first") -> DataFrame:
    """Airports with each code once: the likeliest port by its type, then by name.

    Codes repeat in public airport data, for closed fields among others; a join on them
    would multiply arrivals. `repeated="error"` raises instead, "all" keeps every row.
    """
    order = []
    if "airport_type" in airports.columns:
        types = F.array(*[F.lit(name) for name in AIRPORT_TYPES])
        rank = F.array_position(types, F.col("airport_type"))
        order.append(F.coalesce(F.nullif(rank, F.lit(0)), F.lit(len(AIRPORT_TYPES) + 1)))
    order += [F.col(name) for name in ("airport_name",) if name in airports.columns]
    return _guarded(airports, ["airport_code"], order, repeated)


def enrich_airport(arrivals: DataFrame, airports: DataFrame, repeated: str = "first") -> DataFrame:
    """Arrivals with their airport's columns, by airport code; as many rows as before.

    The fact table holds port codes, which often differ from IATA codes; see
    `key_coverage` for the share that matches. `repeated` says what happens to codes of
    several airports, see `one_airport_per_code`.
    """
    airports = one_airport_per_code(airports, repeated)
    return left_lookup(arrivals, airports, [("airport_code", "airport_code")])


def airport_temperature(
    airports: DataFrame, temperature: DataFrame, grain: str | None = None
) -> DataFrame:
    """Airports with the temperature of their municipality, per time grain if given."""
    return left_lookup(airports, temperature_by(temperature, grain), [("municipality", "city")])


def airport_demographics(
    airports: DataFrame, demographics: DataFrame, match_state: bool = True
) -> DataFrame:
    """Airports (or any rows that carry an airport's columns) with the demographics of
    their municipality.

    With `match_state`, 'US-OR' airports meet only cities of state 'OR'; without it, every
    city of that name in any state gives a row.
    """
    on: list[tuple[str | Column, str]] = [("municipality", "city")]
    if match_state:
        on.append((us_state_code(F.col("iso_country"), F.col("iso_region")), "state_code"))
    return left_lookup(airports, demographics, on)


def demographics_temperature(
    demographics: DataFrame, temperature: DataFrame, grain: str | None = None
) -> DataFrame:
    """Cities with their temperature, per time grain if given."""
    return left_lookup(demographics, temperature_by(temperature, grain), [("city", "city")])


def snowflake(
    lake: Mapping[str, DataFrame], match_state: bool = True, repeated: str = "first"
) -> DataFrame:
    """Every arrival with decoded codes, airport, city demographics and the usual
    temperature of the arrival month in that city.

    As many rows as arrivals: of several airports of one code the likeliest counts, and of
    several rows of one city and state the first by all columns; `repeated="error"` raises
    instead and "all" gives a row for each. Without `match_state` every city of that name in
    any state gives a row.

    Each dimension is joined straight to the fact table. Spark knows the size of a stored
    table and broadcasts it when small; the size of two dimensions joined to each other it
    would guess as their product, and shuffle the facts for it.
    """
    decoded = decode_arrivals(lake["immigration"], lake)
    located = enrich_airport(decoded, lake["airport_codes"], repeated)
    cities = lake["demographics"]
    if match_state:
        cities = _guarded(cities, ["city", "state_code"], [], repeated)
    peopled = airport_demographics(located, cities, match_state)
    monthly = temperature_by(lake["temperature"], "month")
    return left_lookup(peopled, monthly, [("municipality", "city"), ("month", "month")])


def decode_arrivals(arrivals: DataFrame, lake: Mapping[str, DataFrame]) -> DataFrame:
    """Arrivals with the texts of their address, port and visa codes."""
    decoded = decode(arrivals, "address", lake["address_desc"], "address_name")
    decoded = decode(
        decoded, "airport_code", lake["airport_desc"], "port_name", "is_placeholder"
    )
    return decode(decoded, "visacode", lake["visacode_desc"], "visa_name")
