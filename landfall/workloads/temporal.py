"""Joins and counts along time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import asof_join
from landfall.plans import stays
from landfall.workloads import frames
from landfall.workloads.joins import lake
from landfall.workloads.registry import load, query

# Days between the first order and the first event, so that dates of both meet. Events fill
# one month, orders eighty; they are dealt to months by number.
_SHIFT, _MONTHS, _DAYS = 10_592, 80, 30
_EVENT_DAY = f"(ts::date - {_SHIFT} + (event_id % {_MONTHS})::int * {_DAYS})::date"


def _event_day() -> Column:
    shifted = F.date_sub(F.col("ts").cast("date"), _SHIFT)
    return F.date_add(shifted, (F.col("event_id") % _MONTHS * _DAYS).cast("int"))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of twenty of the cities; most days of a city have none."""
    return load(spark, sf_dir, "events").select(
        _event_day().cast("string").alias("dt"),
        F.col("value").alias("avg_temperature"),
        F.concat(F.lit("NATION_"), F.col("user_id") % 20).alias("city"),
    )


_READINGS = f"""
readings as (select {_EVENT_DAY} as day, value, 'NATION_' || (user_id % 20) as city from events),
daily as (select city as town, day as reading_day, count(*) as readings,
                 round(avg(value), 6) as avg_temperature from readings group by 1, 2),
located as (select arrival_id, arrival_date, municipality as city
            from arrivals left join airports using (airport_code))"""


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = lake(spark, sf_dir, "immigration", "airport_codes")
    return stays.arrival_cities(tables["immigration"], tables["airport_codes"])


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {_READINGS}
select arrival_id, city, reading_day, avg_temperature, readings
from located asof left join daily on city = town and arrival_date >= reading_day""")
def weather_before_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last reading up to each arrival in its city; cities without readings stay."""
    located = _located(spark, sf_dir).select("arrival_id", "arrival_date", "city")
    found = stays.weather_before_arrival(located, _readings(spark, sf_dir))
    return found.drop("arrival_date")


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {_READINGS},
found as (select * from located asof left join daily on city = town and arrival_date >= reading_day)
select arrival_id, case when arrival_date - reading_day <= 3 then reading_day end as reading_day
from found""")
def weather_within_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, if that reading is no more than three days old."""
    located = _located(spark, sf_dir).select("arrival_id", "arrival_date", "city")
    found = stays.weather_before_arrival(located, _readings(spark, sf_dir), within=3)
    return found.select("arrival_id", "reading_day")


@query("""
with pairs as (
  select a.event_id, min(b.ts) as next_ts from events a
  left join events b on a.user_id = b.user_id and b.event_type = 'error' and b.ts > a.ts
  where a.event_type <> 'error' group by 1)
select event_id, next_ts from pairs""")
def next_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward and strictly after: each event's next error of the same user."""
    events = load(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select(
        F.col("user_id").alias("who"), F.col("ts").alias("next_ts")
    )
    others = events.where("event_type <> 'error'").select("event_id", "user_id", "ts")
    found = asof_join(
        others, errors, ("ts", "next_ts"), [("user_id", "who")], direction="forward", exact=False
    )
    return found.select("event_id", "next_ts")


_SPELLS = f"""
spells as (
  select 'NATION_' || (user_id % 20) as place, event_type as spell, event_id % 7 as part,
         min({_EVENT_DAY}) as first_day, max({_EVENT_DAY}) as last_day
  from events group by 1, 2, 3, event_id % {_MONTHS})"""


def _spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated periods of a day to a month in each city."""
    events = load(spark, sf_dir, "events")
    return events.groupBy(
        F.concat(F.lit("NATION_"), F.col("user_id") % 20).alias("place"),
        F.col("event_type").alias("spell"),
        (F.col("event_id") % 7).alias("part"),
        (F.col("event_id") % _MONTHS).alias("month"),
    ).agg(F.min(_event_day()).alias("first_day"), F.max(_event_day()).alias("last_day")).drop("month")


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}, {_SPELLS},
stays as (select arrival_id, municipality as city, arrival_date,
                 (arrival_date + stay_duration::int)::date as departure_date
          from arrivals left join airports using (airport_code))
select arrival_id, spell, part, first_day, last_day,
       (least(departure_date, last_day) - greatest(arrival_date, first_day) + 1)::int as shared_days
from stays join spells on city = place
 and arrival_date <= last_day and first_day <= departure_date""")
def stays_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays against dated periods of their city: every pair that overlaps."""
    located = _located(spark, sf_dir).select("arrival_id", "city", "arrival_date", "stay_duration")
    met = stays.stays_in_periods(located, _spells(spark, sf_dir), [("city", "place")])
    return met.select("arrival_id", "spell", "part", "first_day", "last_day", "shared_days")


@query(f"""
with {frames.ARRIVALS},
stays as (select address, arrival_date as first_day,
                 (arrival_date + stay_duration::int)::date as last_day from arrivals),
bounds as (select address, min(first_day) as lo, max(last_day) as hi from stays group by 1),
days as (select address, unnest(generate_series(lo, hi, interval 1 day))::date as day from bounds)
select days.address, day, count(first_day) as present from days
left join stays on stays.address is not distinct from days.address
  and day between first_day and last_day
group by 1, 2""")
def visitors_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is present on each day, per address; the missing address is one of them."""
    return stays.visitors_present(frames.arrivals(spark, sf_dir), ["address"])


@query(f"""
with {frames.ARRIVALS},
changes as (
  select arrival_date as day, 1 as step from arrivals
  union all select (arrival_date + stay_duration::int + 1)::date, -1 from arrivals),
per_day as (select day, sum(step) as step from changes group by 1),
days as (select unnest(generate_series((select min(day) from per_day),
                                       (select max(day) from per_day) - 1, interval 1 day))::date as day)
select days.day, (sum(coalesce(step, 0)) over (order by days.day))::bigint as present
from days left join per_day using (day)""")
def visitors_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all ports: one calendar, summed in ranges of days."""
    return stays.visitors_present(frames.arrivals(spark, sf_dir), [])
