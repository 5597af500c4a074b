"""The lake's questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.columns import period_columns
from landfall.operators import aggregates, average_by, left_lookup
from landfall.plans import questions
from landfall.workloads import frames
from landfall.workloads.joins import lake
from landfall.workloads.registry import load, query


@query("select event_type, count(*) as n from events group by 1")
def count_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key."""
    return aggregates.count_by(load(spark, sf_dir, "events"), "event_type")


@query("select ts::date as day, count(*) as n from events group by 1")
def count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date."""
    events = load(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"))
    return aggregates.count_by(events, "day")


@query("select count(*) as n from lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in all."""
    return aggregates.count_by(load(spark, sf_dir, "lineitem"))


@query("""
select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 10""")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten keys with the most rows."""
    return aggregates.top_k(load(spark, sf_dir, "orders"), ["o_custkey"], 10)


@query(f"""
with {frames.ARRIVALS}
select year, month, count(*) as arrivals from arrivals group by 1, 2""")
def arrivals_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which months are heaviest."""
    return questions.arrivals_by_month(frames.arrivals(spark, sf_dir))


@query(f"""
with {frames.ARRIVALS}, {frames.PORT_CODES},
busiest as (select airport_code, count(*) as arrivals from arrivals group by 1
            order by arrivals desc, airport_code limit 10)
select airport_code, arrivals, value as port_name,
       coalesce(value like 'No PORT Code%', false) as is_placeholder
from busiest left join airport_desc on airport_code = key""")
def top_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where most people arrive."""
    return questions.top_ports(frames.arrivals(spark, sf_dir), frames.port_codes(spark, sf_dir))


@query("""
select o_orderpriority, round(avg(d), 6) as avg_days, quantile_cont(d, 0.5) as median_days,
       min(d) as min_days, max(d) as max_days, count(d) as n
from (select o_orderpriority, date_diff('day', o_orderdate, l_shipdate)::double as d
      from lineitem join orders on l_orderkey = o_orderkey) group by 1""")
def stay_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of stay per key."""
    items = frames.items_with_orders(spark, sf_dir)
    days = F.datediff("l_shipdate", "o_orderdate").cast("double")
    return aggregates.stay_stats(items.withColumn("stay_duration", days), ["o_orderpriority"])


@query("""
select o_orderpriority, round(avg(d), 6) as avg_days, quantile_cont(d, 0.5) as median_days,
       min(d) as min_days, max(d) as max_days, count(d) as n
from (select o_orderpriority, case when l_quantity <> 50
        then date_diff('day', o_orderdate, l_shipdate) / 4 end as d
      from lineitem join orders on l_orderkey = o_orderkey) group by 1""")
def stay_stats_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of stay in fractions of a day; NaN is missing."""
    items = frames.items_with_orders(spark, sf_dir)
    days = F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(
        F.datediff("l_shipdate", "o_orderdate") / 4
    )
    return aggregates.stay_stats(items.withColumn("stay_duration", days), ["o_orderpriority"])


@query(f"""
with {frames.ARRIVALS}
select visacode, month, round(avg(stay_duration), 6) as avg_days,
       quantile_cont(stay_duration, 0.5) as median_days, min(stay_duration) as min_days,
       max(stay_duration) as max_days, count(stay_duration) as n
from arrivals group by 1, 2""")
def stay_by_visa_and_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of stay per visa code and month."""
    return aggregates.stay_stats(frames.arrivals(spark, sf_dir), ["visacode", "month"])


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {frames.DEMOGRAPHICS},
per_port as (select airport_code, count(*) as arrivals,
                    round(avg(stay_duration), 6) as avg_stay from arrivals group by 1)
select per_port.airport_code, arrivals, avg_stay, airport_name, municipality, iso_region,
       population, median_age, foreign_born
from per_port left join airports on per_port.airport_code = airports.airport_code
left join demographics on municipality = city
  and case when iso_country = 'US' then substring(iso_region, 4) end = state_code""")
def airport_city_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports of arrival and their cities."""
    return questions.airport_city_profile(lake(
        spark, sf_dir, "immigration", "airport_codes", "demographics"
    ))


_PEAKS = """
ranked as (select airport_code, {period} as period, count(*) as arrivals
           from arrivals group by 1, 2),
peaks as (select * from ranked order by arrivals desc, airport_code, period limit {k}),
cities as (select distinct airport_code, municipality as city from airports),
weather as (select city, {weather} as period, count(*) as readings,
                   round(avg(avg_temperature), 6) as avg_temperature
            from temperature group by 1, 2)
select peaks.airport_code, peaks.period as {name}, arrivals, cities.city, avg_temperature, readings
from peaks left join cities on peaks.airport_code = cities.airport_code
left join weather on cities.city = weather.city and peaks.period = weather.period"""


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {frames.TEMPERATURE},
{_PEAKS.format(period="month", weather="month(dt::date)::int", name="month", k=400)}""")
def weather_at_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather in the months with most arrivals, per port; ports without a city stay."""
    tables = lake(spark, sf_dir, "immigration", "airport_codes", "temperature")
    return questions.weather_at_peaks(
        tables["immigration"].drop("arrival_date"),
        tables["airport_codes"],
        tables["temperature"],
        k=400,
        grain="month",
    )


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {frames.TEMPERATURE},
{_PEAKS.format(
    period="day(arrival_date)::int", weather="day(dt::date)::int", name="day_of_month", k=500)}""")
def weather_at_peak_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per day of the month."""
    tables = lake(spark, sf_dir, "immigration", "airport_codes", "temperature")
    return questions.weather_at_peaks(
        tables["immigration"],
        tables["airport_codes"],
        tables["temperature"],
        k=500,
        grain="day_of_month",
    )


# Days between the first order and the first reading, so that dates of both meet.
_SHIFT = 10_592


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS},
temperature as (
  select (ts::date - {_SHIFT})::date as dt, value as avg_temperature,
         'NATION_' || (user_id % 20) as city from events),
{_PEAKS.format(period="arrival_date", weather="dt", name="day", k=500)}""")
def weather_at_peaks_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather on the days with most arrivals, per port; all readings are shifted by a fixed
    number of days, since the given tables lie years apart."""
    tables = lake(spark, sf_dir, "immigration", "airport_codes", "temperature")
    shifted = F.date_sub(F.col("dt").cast("date"), _SHIFT)
    return questions.weather_at_peaks(
        tables["immigration"],
        tables["airport_codes"],
        tables["temperature"].withColumn("dt", shifted),
        k=500,
        grain="day",
    )


@query("""
with d as (select day(o_orderdate)::int as day_of_month, count(*) as arrivals from orders
           group by 1 order by arrivals desc, day_of_month limit 5),
w as (select day(ts)::int as day_of_month, round(avg(value), 6) as avg_value from events group by 1)
select d.day_of_month, arrivals, avg_value from d left join w using (day_of_month)""")
def weather_at_peaks_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The busiest days of the month with the mean reading of that day, without cities."""
    orders = load(spark, sf_dir, "orders").withColumns(
        period_columns(F.col("o_orderdate"), "day_of_month")
    )
    peaks = aggregates.top_k(orders, ["day_of_month"], 5, out="arrivals")
    events = load(spark, sf_dir, "events").withColumns(
        period_columns(F.col("ts"), "day_of_month")
    )
    weather = average_by(events, ["day_of_month"], "value", "avg_value")
    return left_lookup(peaks, weather, [("day_of_month", "day_of_month")])


@query(f"""
with {frames.ARRIVALS}, {frames.ADDRESS_CODES}, {frames.PORT_CODES}, {frames.VISA_CODES}
select arrival_id, a.value as address_name, p.value as port_name, v.value as visa_name
from arrivals
left join address_desc a on address = a.key
left join airport_desc p on airport_code = p.key
left join visacode_desc v on visacode::bigint::varchar = v.key""")
def decoded_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with the texts of their codes."""
    decoded = questions.decoded_arrivals(lake(
        spark, sf_dir, "immigration", "address_desc", "airport_desc", "visacode_desc"
    ))
    return decoded.select("arrival_id", "address_name", "port_name", "visa_name")
