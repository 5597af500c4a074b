"""Table layouts of the lake: source columns, target schemas, rename maps.

Everything in this module is a fixed value: the names and types are the data
contract of the four raw datasets and of the seven lake tables.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_STRING, _DOUBLE, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# --- fixed values: monthly arrival extracts --------------------------------

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

ARRIVAL_REQUIRED = ("i94yr", "i94mon", "i94port", "arrdate", "i94bir")

ARRIVAL_COLUMNS = (
    "i94yr",
    "i94mon",
    "i94port",
    "i94addr",
    "i94visa",
    "arrdate",
    "depdate",
    "biryear",
    "gender",
    "visatype",
)

ARRIVAL_RENAMES = {
    "i94yr": "year",
    "i94mon": "month",
    "i94port": "airport_code",
    "i94addr": "address",
    "i94visa": "visacode",
}

ARRIVED_BY_AIR = 1

# Day zero of SAS day numbers.
SAS_EPOCH = "1960-01-01"

# --- fixed values: raw CSV layouts -----------------------------------------

TEMPERATURE_CSV = T.StructType(
    [
        T.StructField("dt", _STRING),
        T.StructField("AverageTemperature", _DOUBLE),
        T.StructField("AverageTemperatureUncertainty", _DOUBLE),
        T.StructField("City", _STRING),
        T.StructField("Country", _STRING),
        T.StructField("Latitude", _STRING),
        T.StructField("Longitude", _STRING),
    ]
)

TEMPERATURE_RENAMES = {
    "AverageTemperature": "avg_temperature",
    "AverageTemperatureUncertainty": "avg_temperature_uncert",
    "City": "city",
    "Country": "country",
    "Latitude": "latitude",
    "Longitude": "longitude",
}

AIRPORT_CSV = T.StructType(
    [
        T.StructField("ident", _STRING),
        T.StructField("type", _STRING),
        T.StructField("name", _STRING),
        T.StructField("elevation_ft", _DOUBLE),
        T.StructField("continent", _STRING),
        T.StructField("iso_country", _STRING),
        T.StructField("iso_region", _STRING),
        T.StructField("municipality", _STRING),
        T.StructField("gps_code", _STRING),
        T.StructField("iata_code", _STRING),
        T.StructField("local_code", _STRING),
        T.StructField("coordinates", _STRING),
    ]
)

AIRPORT_DROPPED = ("ident", "local_code", "continent", "gps_code")

AIRPORT_RENAMES = {"type": "airport_type", "name": "airport_name", "iata_code": "airport_code"}

DEMOGRAPHICS_CSV = T.StructType(
    [
        T.StructField("City", _STRING),
        T.StructField("State", _STRING),
        T.StructField("Median Age", _DOUBLE),
        T.StructField("Male Population", _DOUBLE),
        T.StructField("Female Population", _DOUBLE),
        T.StructField("Total Population", _LONG),
        T.StructField("Number of Veterans", _DOUBLE),
        T.StructField("Foreign-born", _DOUBLE),
        T.StructField("Average Household Size", _DOUBLE),
        T.StructField("State Code", _STRING),
        T.StructField("Race", _STRING),
        T.StructField("Count", _LONG),
    ]
)

DEMOGRAPHICS_DROPPED = ("Race", "Count")

DEMOGRAPHICS_RENAMES = {
    "City": "city",
    "State": "state",
    "Median Age": "median_age",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "population",
    "Number of Veterans": "veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "avg_household_size",
    "State Code": "state_code",
}

DEMOGRAPHICS_CASTS = {
    "male_population": "bigint",
    "female_population": "bigint",
    "veterans": "bigint",
    "foreign_born": "bigint",
}

DEMOGRAPHICS_RULES = {
    "population_covers_sexes": "population >= male_population + female_population",
    "population_over_foreign_born": "population > foreign_born",
    "population_over_household": "population > avg_household_size",
    "males_over_veterans": "male_population > veterans",
}

# Texts pandas reads as missing by default (public pandas documentation).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Types of airports (public airport data), the likeliest port of arrival first.
AIRPORT_TYPES = (
    "large_airport", "medium_airport", "small_airport", "seaplane_base", "heliport",
    "balloonport", "closed",
)

# Port descriptions that name no place.
PLACEHOLDER_PATTERN = r"^No PORT Code|^Collapsed|UNKNOWN|^UNIDENTIF|^INVALID"

# --- fixed values: lake tables ---------------------------------------------

CODE_MAP = _struct(key=_STRING, value=_STRING)

LAKE_SCHEMAS = {
    "immigration": _struct(
        year=_INT,
        month=_INT,
        airport_code=_STRING,
        address=_STRING,
        visacode=_DOUBLE,
        biryear=_DOUBLE,
        gender=_STRING,
        visatype=_STRING,
        stay_duration=_DOUBLE,
    ),
    "temperature": _struct(
        dt=_STRING,
        avg_temperature=_DOUBLE,
        avg_temperature_uncert=_DOUBLE,
        city=_STRING,
        country=_STRING,
        latitude=_STRING,
        longitude=_STRING,
    ),
    "airport_codes": _struct(
        airport_type=_STRING,
        airport_name=_STRING,
        elevation_ft=_DOUBLE,
        iso_country=_STRING,
        iso_region=_STRING,
        municipality=_STRING,
        airport_code=_STRING,
        coordinates=_STRING,
    ),
    "demographics": _struct(
        city=_STRING,
        state=_STRING,
        median_age=_DOUBLE,
        male_population=_LONG,
        female_population=_LONG,
        population=_LONG,
        veterans=_LONG,
        foreign_born=_LONG,
        avg_household_size=_DOUBLE,
        state_code=_STRING,
    ),
    "address_desc": CODE_MAP,
    "airport_desc": CODE_MAP,
    "visacode_desc": CODE_MAP,
}

LAKE_PARTITIONS = {
    "immigration": ("month",),
    "temperature": ("city",),
    "airport_codes": ("iso_country",),
    "demographics": ("state_code",),
}

# What identifies a row of a dimension; lookups repeat facts where it does not.
LAKE_KEYS = {
    "airport_codes": ("airport_code",),
    "demographics": ("city", "state_code"),
    "address_desc": ("key",),
    "airport_desc": ("key",),
    "visacode_desc": ("key",),
}
