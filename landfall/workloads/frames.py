"""Raw and lake tables derived from the given tables, as frames and as SQL.

Orders stand for arrivals, customers for airports, nations for cities, market segments
for states and events for temperature readings. The given tables hold no missing values
and no repeated rows, so both are induced here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.columns import day_number
from landfall.workloads.registry import load


def null_if(column: Column, value) -> Column:
    """NULL where the column equals the value."""
    return F.nullif(column, F.lit(value))


def items_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the date, status and priority of their order."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    items = load(spark, sf_dir, "lineitem")
    return items.join(orders, items.l_orderkey == orders.o_orderkey)


# --- raw arrivals -----------------------------------------------------------


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the layout of a monthly extract; lines of January occur twice."""
    rows = items_with_orders(spark, sf_dir).select(
        F.col("l_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        null_if(F.substring("o_orderpriority", 3, 3), "LOW").alias("i94port"),
        F.col("o_orderstatus").alias("i94addr"),
        F.when(F.col("l_linestatus") == "F", 1.0)
        .when(F.col("l_returnflag") == "N", 2.0)
        .alias("i94mode"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("i94visa"),
        null_if(F.col("l_quantity"), 50.0).alias("i94bir"),
        day_number(F.col("o_orderdate")).cast("double").alias("arrdate"),
        F.when(F.col("l_tax") < 0.075, day_number(F.col("l_shipdate")).cast("double")).alias(
            "depdate"
        ),
        (2016 - F.col("l_quantity")).alias("biryear"),
        null_if(F.col("l_returnflag"), "N").alias("gender"),
        F.col("l_linestatus").alias("visatype"),
        F.col("l_partkey").alias("admnum"),
    )
    return rows.unionByName(rows.where(F.col("i94mon") == 1))


RAW_ARRIVALS = """
raw_once as (
  select l_orderkey::double as cicid,
         year(o_orderdate)::double as i94yr,
         month(o_orderdate)::double as i94mon,
         nullif(substring(o_orderpriority, 3, 3), 'LOW') as i94port,
         o_orderstatus as i94addr,
         case when l_linestatus = 'F' then 1.0::double
              when l_returnflag = 'N' then 2.0::double end as i94mode,
         substring(o_orderpriority, 1, 1)::double as i94visa,
         nullif(l_quantity, 50.0) as i94bir,
         date_diff('day', date '1960-01-01', o_orderdate::date)::double as arrdate,
         case when l_tax < 0.075
              then date_diff('day', date '1960-01-01', l_shipdate::date)::double end as depdate,
         2016 - l_quantity as biryear,
         nullif(l_returnflag, 'N') as gender,
         l_linestatus as visatype,
         l_partkey as admnum
  from lineitem join orders on l_orderkey = o_orderkey),
raw_arrivals as (select * from raw_once union all select * from raw_once where i94mon = 1)"""


# --- raw dimension tables ---------------------------------------------------


def raw_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the layout of the temperature table."""
    return load(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        null_if(F.col("value"), 0.01).alias("AverageTemperature"),
        F.when(F.col("value") < 200, F.round(F.col("value") / 10, 3)).alias(
            "AverageTemperatureUncertainty"
        ),
        F.concat(F.lit("NATION_"), F.col("user_id") % 25).alias("City"),
        F.when(F.col("event_type") == "error", "Canada")
        .otherwise("United States")
        .alias("Country"),
        F.col("user_id").cast("string").alias("Latitude"),
        F.col("event_type").alias("Longitude"),
    )


RAW_TEMPERATURE = """
raw_temperature as (
  select strftime(ts, '%Y-%m-%d') as dt,
         nullif(value, 0.01) as avg_temperature,
         case when value < 200 then round(value / 10, 3) end as avg_temperature_uncert,
         'NATION_' || (user_id % 25) as city,
         case when event_type = 'error' then 'Canada' else 'United States' end as country,
         user_id::varchar as latitude,
         event_type as longitude
  from events)"""


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the layout of the airport table; one segment has no code."""
    customers = load(spark, sf_dir, "customer")
    nations = load(spark, sf_dir, "nation")
    country = F.when(F.col("n_regionkey") < 3, "US").otherwise("CA")
    segment = F.substring("c_mktsegment", 1, 2)
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("ident"),
        F.lower("c_mktsegment").alias("type"),
        F.concat(F.lit('The "'), F.col("c_name"), F.lit('", airport')).alias("name"),
        F.col("c_acctbal").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        country.alias("iso_country"),
        F.concat(country, F.lit("-"), segment).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.lit(None).cast("string").alias("gps_code"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("C"), F.col("c_custkey"))
        ).alias("iata_code"),
        F.col("c_custkey").cast("string").alias("local_code"),
        F.col("c_acctbal").cast("string").alias("coordinates"),
    )


AIRPORTS = """
airports as (
  select lower(c_mktsegment) as airport_type,
         'The "' || c_name || '", airport' as airport_name,
         c_acctbal as elevation_ft,
         case when n_regionkey < 3 then 'US' else 'CA' end as iso_country,
         case when n_regionkey < 3 then 'US' else 'CA' end || '-'
           || substring(c_mktsegment, 1, 2) as iso_region,
         n_name as municipality,
         'C' || c_custkey as airport_code
  from customer join nation on c_nationkey = n_nationkey
  where c_mktsegment <> 'MACHINERY')"""


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by nation, repeated for every order line, as the races repeat a city."""
    items = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber")
    suppliers = load(spark, sf_dir, "supplier")
    people = F.abs(F.floor("s_acctbal")).cast("double")
    return items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("City"),
        F.concat(F.lit("State "), F.col("s_nationkey")).alias("State"),
        F.col("s_acctbal").alias("Median Age"),
        people.alias("Male Population"),
        (people / 2).alias("Female Population"),
        (people + 100).cast("bigint").alias("Total Population"),
        null_if(people * 2, 0.0).alias("Number of Veterans"),
        F.abs(F.col("s_acctbal")).alias("Foreign-born"),
        F.lit(2.5).alias("Average Household Size"),
        F.col("s_nationkey").cast("string").alias("State Code"),
        F.col("l_returnflag").alias("Race"),
        null_if(F.col("l_linenumber").cast("bigint"), 7).alias("Count"),
    )


# --- lake tables --------------------------------------------------------------


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the layout of the fact table, with the arrival date kept."""
    priority = F.substring("o_orderpriority", 1, 1)
    return load(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("airport_code"),
        null_if(F.col("o_orderstatus"), "P").alias("address"),
        priority.cast("double").alias("visacode"),
        F.floor(F.col("o_totalprice") / 10000).cast("double").alias("stay_duration"),
        F.col("o_orderdate").cast("date").alias("arrival_date"),
        F.col("o_orderkey").alias("arrival_id"),
    )


ARRIVALS = """
arrivals as (
  select year(o_orderdate)::int as year,
         month(o_orderdate)::int as month,
         'C' || o_custkey as airport_code,
         nullif(o_orderstatus, 'P') as address,
         substring(o_orderpriority, 1, 1)::double as visacode,
         floor(o_totalprice / 10000)::double as stay_duration,
         o_orderdate::date as arrival_date,
         o_orderkey as arrival_id
  from orders)"""


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation and segment, in the layout of the demographics table."""
    customers = load(spark, sf_dir, "customer")
    nations = load(spark, sf_dir, "nation")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(
        F.col("n_name").alias("city"), F.substring("c_mktsegment", 1, 2).alias("state_code")
    ).agg(
        F.count(F.lit(1)).alias("population"),
        F.min("c_acctbal").alias("median_age"),
        F.count_if(F.col("c_acctbal") < 0).alias("foreign_born"),
    )


DEMOGRAPHICS = """
demographics as (
  select n_name as city, substring(c_mktsegment, 1, 2) as state_code,
         count(*) as population, min(c_acctbal) as median_age,
         count(*) filter (c_acctbal < 0) as foreign_born
  from customer join nation on c_nationkey = n_nationkey group by 1, 2)"""


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the layout of the temperature table of the lake."""
    return load(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("value").alias("avg_temperature"),
        F.concat(F.lit("NATION_"), F.col("user_id") % 20).alias("city"),
    )


TEMPERATURE = """
temperature as (
  select strftime(ts, '%Y-%m-%d') as dt, value as avg_temperature,
         'NATION_' || (user_id % 20) as city
  from events)"""


def address_codes(spark: SparkSession) -> DataFrame:
    """A code map that lacks one code."""
    return spark.sql(f"SELECT * FROM {_ADDRESS_VALUES} AS t(key, value)")


_ADDRESS_VALUES = "VALUES ('F', 'Filled'), ('O', 'Open'), ('77', 'Elsewhere')"
ADDRESS_CODES = f"address_desc(key, value) as ({_ADDRESS_VALUES})"


def visa_codes(spark: SparkSession) -> DataFrame:
    """A code map with keys that look like numbers."""
    return spark.sql(f"SELECT * FROM {_VISA_VALUES} AS t(key, value)")


_VISA_VALUES = "VALUES ('1', 'Work'), ('2', 'Leisure'), ('3', 'Study')"
VISA_CODES = f"visacode_desc(key, value) as ({_VISA_VALUES})"


def port_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a code map of ports; one segment names no place, one is absent."""
    code = F.concat(F.lit("C"), F.col("c_custkey"))
    return (
        load(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") != "FURNITURE")
        .select(
            code.alias("key"),
            F.when(
                F.col("c_mktsegment") == "BUILDING",
                F.concat(F.lit("No PORT Code ("), code, F.lit(")")),
            )
            .otherwise(F.col("c_name"))
            .alias("value"),
        )
    )


PORT_CODES = """
airport_desc as (
  select 'C' || c_custkey as key,
         case when c_mktsegment = 'BUILDING' then 'No PORT Code (C' || c_custkey || ')'
              else c_name end as value
  from customer where c_mktsegment <> 'FURNITURE')"""
