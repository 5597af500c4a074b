"""The conforming dataflows on raw tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.operators import StepCounter, run_checks
from landfall.plans import conform, edges
from landfall.sinks import write_table
from landfall.workloads import frames
from landfall.workloads.registry import query, scratch

_CONFORMED_ARRIVALS = f"""
with {frames.RAW_ARRIVALS},
conformed as (
  select i94yr::int as year, i94mon::int as month, i94port as airport_code,
         i94addr as address, i94visa as visacode, biryear, gender, visatype,
         depdate - arrdate as stay_duration, arrdate
  from (select distinct * from raw_arrivals)
  where i94mode = 1 and i94yr is not null and i94mon is not null
    and i94port is not null and arrdate is not null and i94bir is not null)"""


CONFORMED_ARRIVALS = f"{_CONFORMED_ARRIVALS} select * exclude (arrdate) from conformed"
CONFORMED_AIRPORTS = f"""
with {frames.AIRPORTS}
select a.*, c_acctbal::varchar as coordinates
from airports a join customer on airport_code = 'C' || c_custkey"""


@query(CONFORMED_ARRIVALS)
def conform_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrivals to the fact table."""
    return conform.conform_arrivals(frames.raw_arrivals(spark, sf_dir))


@query(f"""
{_CONFORMED_ARRIVALS}
select *  exclude (arrdate), (date '1960-01-01' + arrdate::int)::date as arrival_date
from conformed""")
def conform_arrivals_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the arrival date kept."""
    return conform.conform_arrivals(frames.raw_arrivals(spark, sf_dir), keep_arrival_date=True)


@query(f"""
{_CONFORMED_ARRIVALS}
select check_name, target, violations, rows_checked, violations = 0 as passed from (
  select 'not_empty' as check_name, '*' as target, (count(*) = 0)::bigint as violations,
         count(*) as rows_checked from conformed
  union all select 'not_null', 'year', count(*) filter (year is null), count(*) from conformed
  union all select 'not_null', 'month', count(*) filter (month is null), count(*) from conformed
  union all select 'not_null', 'airport_code', count(*) filter (airport_code is null), count(*)
    from conformed
  union all select 'rule', 'stay_not_negative', count(*) filter (stay_duration < 0), count(*)
    from conformed)""")
def check_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table's checks in one pass."""
    conformed = conform.conform_arrivals(frames.raw_arrivals(spark, sf_dir))
    return run_checks(conformed, conform.arrival_checks(conformed))


@query(f"""
with {frames.RAW_TEMPERATURE}
select * from raw_temperature
where avg_temperature is not null and avg_temperature_uncert is not null
  and country = 'United States' and dt >= '2024-01-10'""")
def conform_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw temperatures to the temperature table."""
    return conform.conform_temperature(
        frames.raw_temperature(spark, sf_dir), from_day="2024-01-10"
    )


@query(f"""
with {frames.RAW_TEMPERATURE}
select city, count(distinct (latitude, longitude)) as places, count(*) as readings
from raw_temperature
where avg_temperature is not null and avg_temperature_uncert is not null
  and country = 'United States' and dt >= '2024-01-10'
group by city""")
def city_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that share a city name, over the conformed temperatures."""
    return edges.city_places(
        conform.conform_temperature(frames.raw_temperature(spark, sf_dir), from_day="2024-01-10")
    )


@query(f"""
with {frames.RAW_ARRIVALS}, once as (select distinct * from raw_arrivals),
air as (select * from once where i94mode = 1)
select 'read' as step, count(*) as n from raw_arrivals
union all select 'distinct', count(*) from once
union all select 'by_air', count(*) from air
union all select 'complete', count(*) from air
  where i94yr is not null and i94mon is not null and i94port is not null
    and arrdate is not null and i94bir is not null""")
def arrival_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each step of the fact dataflow, counted while its result is written."""
    counter = StepCounter()
    facts = conform.conform_arrivals(frames.raw_arrivals(spark, sf_dir), counter=counter)
    write_table(facts, scratch(spark, "facts_counted"), ["month"])
    return spark.createDataFrame(list(counter.counts().items()), "step string, n bigint")


@query(CONFORMED_AIRPORTS)
def conform_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw airports to the airport table."""
    return conform.conform_airports(frames.raw_airports(spark, sf_dir))


_DEMOGRAPHICS = """
with people as (select *, abs(floor(s_acctbal)) as p from supplier),
conformed as (
  select s_name as city, 'State ' || s_nationkey as state, s_acctbal as median_age,
         p::bigint as male_population, trunc(p / 2)::bigint as female_population,
         (p + 100)::bigint as population, (p * 2)::bigint as veterans,
         trunc(abs(s_acctbal))::bigint as foreign_born, 2.5::double as avg_household_size,
         s_nationkey::varchar as state_code
  from people
  where p <> 0
    and s_suppkey in (select l_suppkey from lineitem where l_linenumber <> 7))"""


CONFORMED_DEMOGRAPHICS = f"{_DEMOGRAPHICS} select * from conformed"


@query(CONFORMED_DEMOGRAPHICS)
def conform_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw demographics to one row per city and state."""
    return conform.conform_demographics(frames.raw_demographics(spark, sf_dir))


@query(f"""
{_DEMOGRAPHICS}
select 'rule' as check_name, target, violations, rows_checked, violations = 0 as passed from (
  select 'population_covers_sexes' as target,
         count(*) filter (not population >= male_population + female_population) as violations,
         count(*) as rows_checked from conformed
  union all select 'population_over_foreign_born',
    count(*) filter (not population > foreign_born), count(*) from conformed
  union all select 'population_over_household',
    count(*) filter (not population > avg_household_size), count(*) from conformed
  union all select 'males_over_veterans',
    count(*) filter (not male_population > veterans), count(*) from conformed)""")
def check_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four population rules in one pass."""
    conformed = conform.conform_demographics(frames.raw_demographics(spark, sf_dir))
    return run_checks(conformed, conform.demographics_checks())
