"""Lookups and the snowflake join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import count_by, decode, lookups
from landfall.plans import conform
from landfall.plans import edges
from landfall.workloads import frames
from landfall.workloads.registry import load, query

_PLACEHOLDER = (
    "coalesce(regexp_matches(value, '^No PORT Code|^Collapsed|UNKNOWN|^INVALID'), false)"
)


_LAKE = {
    "immigration": frames.arrivals,
    "temperature": frames.temperature,
    "airport_codes": lambda spark, sf: conform.conform_airports(frames.raw_airports(spark, sf)),
    "demographics": frames.demographics,
    "address_desc": lambda spark, sf: frames.address_codes(spark),
    "airport_desc": frames.port_codes,
    "visacode_desc": lambda spark, sf: frames.visa_codes(spark),
}


def lake(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Tables of the lake derived from the given ones; all of them by default."""
    return {name: _LAKE[name](spark, sf_dir) for name in names or _LAKE}


@query("""
select o_orderkey, value as status_name from orders
left join (values ('F', 'Filled'), ('O', 'Open'), ('99', 'All Other Codes')) as m(key, value)
  on o_orderstatus = key""")
def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text codes; unknown codes stay with NULL."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return decode(orders, "o_orderstatus", frames.address_codes(spark), "status_name").drop(
        "o_orderstatus"
    )


@query(f"""
with {frames.ARRIVALS}, {frames.VISA_CODES}
select arrival_id, visacode, value as visa_name
from arrivals left join visacode_desc on visacode::bigint::varchar = key""")
def decode_numeric_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes held as doubles against keys held as text."""
    arrivals = frames.arrivals(spark, sf_dir).select("arrival_id", "visacode")
    return decode(arrivals, "visacode", frames.visa_codes(spark), "visa_name")


@query(f"""
with {frames.ARRIVALS}, {frames.PORT_CODES}
select arrival_id, airport_code, value as port_name, {_PLACEHOLDER} as is_placeholder
from arrivals left join airport_desc on airport_code = key""")
def decode_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port codes, with a flag for descriptions that name no place."""
    arrivals = frames.arrivals(spark, sf_dir).select("arrival_id", "airport_code")
    return decode(
        arrivals, "airport_code", frames.port_codes(spark, sf_dir), "port_name", "is_placeholder"
    )


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}
select arrival_id, arrivals.airport_code, airport_name, municipality, iso_region
from arrivals left join airports using (airport_code)""")
def enrich_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with their airport."""
    tables = lake(spark, sf_dir, "immigration", "airport_codes")
    enriched = edges.enrich_airport(tables["immigration"], tables["airport_codes"])
    return enriched.select(
        "arrival_id", "airport_code", "airport_name", "municipality", "iso_region"
    )


@query(f"""
with {frames.AIRPORTS}, {frames.TEMPERATURE},
monthly as (select city, month(dt::date)::int as month, count(*) as readings,
                   round(avg(avg_temperature), 6) as avg_temperature
            from temperature group by 1, 2)
select airport_code, municipality, month, avg_temperature, readings
from airports left join monthly on municipality = city""")
def airport_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports with the monthly temperature of their city."""
    tables = lake(spark, sf_dir, "airport_codes", "temperature")
    joined = edges.airport_temperature(tables["airport_codes"], tables["temperature"], "month")
    return joined.select("airport_code", "municipality", "month", "avg_temperature", "readings")


@query(f"""
with {frames.AIRPORTS}, {frames.DEMOGRAPHICS}
select airport_code, municipality, iso_region, population, median_age, foreign_born
from airports left join demographics
  on municipality = city
 and case when iso_country = 'US' then substring(iso_region, 4) end = state_code""")
def airport_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports with the demographics of their city, matched on the state too."""
    tables = lake(spark, sf_dir, "airport_codes", "demographics")
    joined = edges.airport_demographics(tables["airport_codes"], tables["demographics"])
    return joined.select(
        "airport_code", "municipality", "iso_region", "population", "median_age", "foreign_born"
    )


@query(f"""
with {frames.AIRPORTS}, {frames.DEMOGRAPHICS}
select airport_code, municipality, state_code, population
from airports left join demographics on municipality = city""")
def airport_demographics_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the city alone: one row for every state that has such a city."""
    tables = lake(spark, sf_dir, "airport_codes", "demographics")
    joined = edges.airport_demographics(
        tables["airport_codes"], tables["demographics"], match_state=False
    )
    return joined.select("airport_code", "municipality", "state_code", "population")


@query(f"""
with {frames.DEMOGRAPHICS}, {frames.TEMPERATURE},
overall as (select city, round(avg(avg_temperature), 6) as avg_temperature,
                   count(*) as readings from temperature group by 1)
select city, state_code, population, avg_temperature, readings
from demographics left join overall using (city)""")
def demographics_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with their mean temperature."""
    tables = lake(spark, sf_dir, "demographics", "temperature")
    joined = edges.demographics_temperature(tables["demographics"], tables["temperature"])
    return joined.select("city", "state_code", "population", "avg_temperature", "readings")


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {frames.DEMOGRAPHICS}, {frames.TEMPERATURE},
{frames.ADDRESS_CODES}, {frames.PORT_CODES}, {frames.VISA_CODES},
monthly as (select city, month(dt::date)::int as month,
                   round(avg(avg_temperature), 6) as avg_temperature
            from temperature group by 1, 2)
select arrival_id, arrivals.month, a.value as address_name, p.value as port_name,
       v.value as visa_name, airport_name, municipality, population, avg_temperature
from arrivals
left join address_desc a on address = a.key
left join airport_desc p on arrivals.airport_code = p.key
left join visacode_desc v on visacode::bigint::varchar = v.key
left join airports on arrivals.airport_code = airports.airport_code
left join demographics on municipality = demographics.city
  and case when iso_country = 'US' then substring(iso_region, 4) end = state_code
left join monthly on municipality = monthly.city and arrivals.month = monthly.month""")
def snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival with all dimensions."""
    return edges.snowflake(lake(spark, sf_dir)).select(
        "arrival_id",
        "month",
        "address_name",
        "port_name",
        "visa_name",
        "airport_name",
        "municipality",
        "population",
        "avg_temperature",
    )


@query("""
select r_name, month(o_orderdate)::int as month, count(*) as arrivals
from orders left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey
left join region on n_regionkey = r_regionkey group by 1, 2""")
def snowflake_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per region and month over a chain of dimensions."""
    orders = load(spark, sf_dir, "orders").select(
        "o_custkey", F.month("o_orderdate").alias("month")
    )
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    located = lookups.left_lookup(orders, customers, [("o_custkey", "c_custkey")])
    for table, left, right in (
        ("nation", "c_nationkey", "n_nationkey"),
        ("region", "n_regionkey", "r_regionkey"),
    ):
        located = lookups.left_lookup(located, load(spark, sf_dir, table), [(left, right)])
    return count_by(located, "r_name", "month", out="arrivals")


@query("""
select count(*) as facts, count(c_custkey) as matched,
       count(*) filter (c_custkey is null) as unmatched
from orders left join (select * from customer where c_mktsegment = 'BUILDING')
  on o_custkey = c_custkey""")
def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many facts find their dimension row."""
    building = load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return lookups.key_coverage(
        load(spark, sf_dir, "orders"), building, ("o_custkey", "c_custkey")
    )


@query("""
select o_custkey, count(*) as facts from orders
where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')
group by 1""")
def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys find none."""
    building = load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return lookups.unmatched_keys(
        load(spark, sf_dir, "orders"), building, ("o_custkey", "c_custkey")
    )
