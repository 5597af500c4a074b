"""Dataflows: raw tables to lake tables, and the questions asked of the lake."""

from landfall.plans.build import LakeSources, build_lake
from landfall.plans.conform import (
    airport_checks,
    arrival_checks,
    code_map_checks,
    conform_airports,
    conform_arrivals,
    conform_demographics,
    conform_temperature,
    demographics_checks,
    temperature_checks,
)
from landfall.plans.questions import (
    airport_city_profile,
    arrivals_by_month,
    decoded_arrivals,
    top_ports,
    weather_at_peaks,
)
from landfall.plans.edges import (
    airport_demographics,
    airport_temperature,
    city_places,
    demographics_temperature,
    enrich_airport,
    one_airport_per_code,
    snowflake,
    temperature_by,
)
from landfall.plans.stays import (
    arrival_cities,
    stays_in_periods,
    visitors_present,
    weather_before_arrival,
    with_departure,
)

__all__ = [
    "LakeSources",
    "airport_checks",
    "airport_city_profile",
    "airport_demographics",
    "airport_temperature",
    "arrival_checks",
    "arrival_cities",
    "arrivals_by_month",
    "build_lake",
    "city_places",
    "code_map_checks",
    "conform_airports",
    "conform_arrivals",
    "conform_demographics",
    "conform_temperature",
    "decoded_arrivals",
    "demographics_checks",
    "demographics_temperature",
    "enrich_airport",
    "one_airport_per_code",
    "snowflake",
    "stays_in_periods",
    "temperature_by",
    "temperature_checks",
    "top_ports",
    "visitors_present",
    "weather_at_peaks",
    "weather_before_arrival",
    "with_departure",
]
