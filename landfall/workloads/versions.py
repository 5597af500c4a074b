"""Versioned tables, merges, history, and loads compared row by row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import (
    at_least_two,
    bag_difference,
    bag_intersection,
    merge_history,
    no_nulls,
    not_empty,
    row_changes,
    rules,
    start_history,
)
from landfall.plans import edges
from landfall.sinks import (
    bucketed_lookup,
    hot_keys,
    merge_table,
    publish_checked,
    publish_table,
    read_snapshot,
    snapshot_versions,
    stored_checks,
    write_bucketed,
)
from landfall.workloads import frames
from landfall.workloads.joins import lake
from landfall.workloads.registry import load, query, scratch


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )


@query("""
with months as (
  select year(o_orderdate)::int as year, month(o_orderdate)::int as month, count(*) as n
  from orders group by 1, 2)
select version, year, month,
       case when version = 2 and year = 1996 and month = 3 then 2 * n else n end as n
from months, (values (1), (2)) as versions(version)""")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table, and a refresh of one month: both versions can be read."""
    path = scratch(spark, "orders_versions")
    orders = _dated_orders(spark, sf_dir)
    publish_table(orders, path, ["year", "month"])
    march = orders.where("year = 1996 and month = 3")
    publish_table(march.unionByName(march), path, ["year", "month"], mode="partitions")
    counted = [
        read_snapshot(spark, path, version)
        .groupBy(F.lit(version).alias("version"), "year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
        for version in snapshot_versions(spark, path)
    ]
    return counted[0].unionByName(counted[1])


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _next_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load: in one segment customers leave, change and join; some move to another."""
    changing = F.col("c_mktsegment") == "BUILDING"
    found = _customers(spark, sf_dir).where(~(changing & (F.col("c_custkey") % 7 == 0)))
    moves = changing & (F.col("c_custkey") % 5 == 1)
    found = found.withColumns(
        {
            "c_mktsegment": F.when(moves, "MACHINERY").otherwise(F.col("c_mktsegment")),
            "c_acctbal": F.when(changing & (F.col("c_custkey") % 3 == 0), F.lit(None)).otherwise(F.col("c_acctbal")),
        }
    )
    joined = found.where(changing).withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    return found.unionByName(joined)


_NEXT_CUSTOMERS = """
before as (select c_custkey, c_name, c_acctbal, c_mktsegment from customer),
left_over as (select * from before where not (c_mktsegment = 'BUILDING' and c_custkey % 7 = 0)),
changed as (
  select c_custkey, c_name,
         case when c_mktsegment = 'BUILDING' and c_custkey % 3 = 0 then null else c_acctbal end as c_acctbal,
         case when c_mktsegment = 'BUILDING' and c_custkey % 5 = 1 then 'MACHINERY'
              else c_mktsegment end as c_mktsegment
  from left_over),
later as (select * from changed
          union all select c_custkey + 1000000000, c_name, c_acctbal, c_mktsegment
          from changed where c_mktsegment = 'BUILDING')"""


@query(f"with {_NEXT_CUSTOMERS} select * from later")
def merged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table brought up to date with a later load."""
    path = scratch(spark, "customers_merged")
    publish_table(_customers(spark, sf_dir), path, ["c_mktsegment"])
    merge_table(_next_customers(spark, sf_dir), path, ["c_custkey"], ["c_mktsegment"])
    return read_snapshot(spark, path)


@query(f"""
with {_NEXT_CUSTOMERS},
met as (select before.c_custkey is null as is_new, later.c_custkey is null as is_gone,
               (before.c_acctbal, before.c_mktsegment) is distinct from
               (later.c_acctbal, later.c_mktsegment) as differs,
               before.c_mktsegment as was, later.c_mktsegment as becomes
        from before full join later on before.c_custkey = later.c_custkey),
ends as (select was as segment from met where differs and not is_new
         union select becomes from met where differs and not is_gone)
select count(*) filter (is_new) as inserted,
       count(*) filter (differs and not is_new and not is_gone) as updated,
       count(*) filter (is_gone) as deleted,
       (select count(*) from ends) as partitions_written
from met""")
def merge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What that merge changes, and how few partitions it writes."""
    path = scratch(spark, "customers_merge_report")
    publish_table(_customers(spark, sf_dir), path, ["c_mktsegment"])
    report = merge_table(_next_customers(spark, sf_dir), path, ["c_custkey"], ["c_mktsegment"])
    counts = [F.lit(report.count(kind)).cast("bigint") for kind in ("insert", "update", "delete")]
    # The one row is made from the stored table, so that what is counted can be read.
    return read_snapshot(spark, path).agg(
        F.max(counts[0]).alias("inserted"), F.max(counts[1]).alias("updated"),
        F.max(counts[2]).alias("deleted"),
        F.max(F.lit(len(report.partitions)).cast("bigint")).alias("partitions_written"),
    )


@query(f"""
with {_NEXT_CUSTOMERS}
select later.*, case when before.c_custkey is null then 'insert' else 'update' end as change
from later left join before on before.c_custkey = later.c_custkey
where before.c_custkey is null
   or (before.c_acctbal, before.c_mktsegment) is distinct from (later.c_acctbal, later.c_mktsegment)
union all
select before.*, 'delete' from before where c_custkey not in (select c_custkey from later)""")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a later load adds, changes and drops."""
    return row_changes(_customers(spark, sf_dir), _next_customers(spark, sf_dir), ["c_custkey"])


# Four loads of one table. The third arrives last.
_LOADS = {n: dt.date(2020, 1, day) for n, day in ((1, 1), (2, 8), (3, 15), (4, 22))}


def _customer_load(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    key = F.col("c_custkey")
    segment = F.when(key * number % 5 == 0, "OTHER").when(key * number % 11 != 3, F.col("c_mktsegment"))
    customers = load(spark, sf_dir, "customer").where((key + number) % 7 != 0)
    return customers.select("c_custkey", segment.alias("segment"))


@query("""
with loads(number, day, next_day) as (
  values (1, date '2020-01-01', date '2020-01-08'), (2, date '2020-01-08', date '2020-01-15'),
         (3, date '2020-01-15', date '2020-01-22'), (4, date '2020-01-22', null::date)),
seen as (
  select c_custkey, day, next_day,
         case when c_custkey * number % 5 = 0 then 'OTHER'
              when c_custkey * number % 11 <> 3 then c_mktsegment end as segment
  from customer, loads where (c_custkey + number) % 7 <> 0),
marked as (
  select *, case when lag(next_day) over w = day and lag(segment) over w is not distinct from segment
                 then 0 else 1 end as starts
  from seen window w as (partition by c_custkey order by day)),
islands as (select *, sum(starts) over (partition by c_custkey order by day) as island from marked)
select c_custkey, segment, min(day) as valid_from,
       case when bool_or(next_day is null) then null else max(next_day) end as valid_to
from islands group by c_custkey, segment, island""")
def history_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each row was valid, from four loads of which the third comes late."""
    loads = {n: _customer_load(spark, sf_dir, n) for n in _LOADS}
    history = start_history(loads[1], _LOADS[1])
    for number, following in ((2, None), (4, None), (3, _LOADS[4])):
        history = merge_history(history, loads[number], ["c_custkey"], _LOADS[number], following)
    return history


def _lake_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a faulty load left them: some lost, some there twice."""
    items = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber")
    kept = items.where("l_suppkey % 10 != 3 or l_linenumber != 4")
    return kept.unionByName(items.where("l_suppkey % 10 = 5 and l_linenumber = 6"))


_LAKE_ITEMS = """
raw as (select l_suppkey, l_returnflag, l_linenumber from lineitem),
lake as (select * from raw where l_suppkey % 10 <> 3 or l_linenumber <> 4
         union all select * from raw where l_suppkey % 10 = 5 and l_linenumber = 6)"""


@query(f"""
with {_LAKE_ITEMS},
lost as (select *, count(*) as n from (select * from raw except all select * from lake) group by all),
surplus as (select *, count(*) as n from (select * from lake except all select * from raw) group by all)
select l_suppkey, l_returnflag, l_linenumber, n as lost, 0::bigint as surplus from lost
union all select l_suppkey, l_returnflag, l_linenumber, 0, n from surplus""")
def lost_and_surplus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a load lost and which it has too often; rows may be equal."""
    items = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber")
    return bag_difference(items, _lake_items(spark, sf_dir))


@query(f"""
with {_LAKE_ITEMS}
select *, count(*) as copies from (select * from raw intersect all select * from lake) group by all""")
def shared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows two loads share, with the number of shared copies."""
    items = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber")
    return bag_intersection(items, _lake_items(spark, sf_dir))


def _repeated_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports of which a third share their code with a closed field, and some with a heliport."""
    airports = lake(spark, sf_dir, "airport_codes")["airport_codes"]
    number = F.substring("airport_code", 2, 9).cast("int")
    airports = airports.withColumn("airport_type", F.when(number % 2 == 0, "small_airport").otherwise("heliport"))
    closed = airports.where(number % 3 == 0).withColumns(
        {"airport_type": F.lit("closed"), "municipality": F.lit("Nowhere")}
    )
    large = airports.where(number % 5 == 0).withColumns(
        {"airport_type": F.lit("large_airport"), "airport_name": F.concat("airport_name", F.lit(" II"))}
    )
    return airports.unionByName(closed).unionByName(large)


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}
select arrival_id, municipality,
       case when airports.airport_code is null then null
            when substring(airports.airport_code, 2)::int % 5 = 0 then airport_name || ' II'
            else airport_name end as airport_name
from arrivals left join airports using (airport_code)""")
def enrich_repeated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with the likeliest airport of their code: as many rows as arrivals."""
    arrivals = frames.arrivals(spark, sf_dir)
    enriched = edges.enrich_airport(arrivals, _repeated_airports(spark, sf_dir))
    return enriched.select("arrival_id", "municipality", "airport_name")


@query("select count(*) as facts, count(*) as joined from orders")
def snowflake_repeated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole snowflake over repeated codes and cities keeps the number of facts."""
    tables = lake(spark, sf_dir)
    cities = tables["demographics"]
    tables |= {
        "airport_codes": _repeated_airports(spark, sf_dir),
        "demographics": cities.unionByName(cities.withColumn("population", F.lit(0).cast("bigint"))),
    }
    rows = F.count(F.lit(1))
    joined = edges.snowflake(tables).agg(rows.alias("joined"))
    facts = tables["immigration"].agg(rows.alias("facts"))
    both = facts.unionByName(joined, allowMissingColumns=True)
    return both.agg(F.max("facts").alias("facts"), F.max("joined").alias("joined"))


@query("""
with orders_now as (
  select * from orders
  union all select * from orders where year(o_orderdate) = 1996 and month(o_orderdate) = 3),
found as (
  select 'not_empty' as check_name, '*' as target, (count(*) = 0)::bigint as violations, count(*) as n
    from orders_now
  union all select 'min_distinct', 'o_orderstatus', (count(distinct o_orderstatus) < 2)::bigint, count(*)
    from orders_now
  union all select 'not_null', 'o_orderpriority', count(*) filter (o_orderpriority is null), count(*)
    from orders_now
  union all select 'rule', 'cheap', count(*) filter (not o_totalprice < 100000), count(*) from orders_now
  union all select 'unique', 'o_orderkey', (select count(*) from (
      select o_orderkey from orders_now group by 1 having count(*) > 1)), count(*) from orders_now)
select check_name, target, violations, n as rows_checked, violations = 0 as passed from found""")
def checks_after_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a whole table after one month was refreshed: only that month is counted again."""
    path = scratch(spark, "orders_checked")
    orders = _dated_orders(spark, sf_dir)
    checks = [
        not_empty(), at_least_two("o_orderstatus"), *no_nulls(orders, ["o_orderpriority"]),
        *rules({"cheap": "o_totalprice < 100000"}),
    ]
    publish_checked(orders, path, ["year", "month"], checks=checks, unique=["o_orderkey"])
    march = orders.where("year = 1996 and month = 3")
    twice = march.unionByName(march)
    publish_checked(twice, path, ["year", "month"], "partitions", checks=checks, unique=["o_orderkey"])
    return stored_checks(spark, path)


@query(f"""
with {frames.ARRIVALS}, {frames.AIRPORTS}
select arrival_id, arrivals.airport_code, airport_name, municipality
from arrivals left join airports using (airport_code)""")
def enrich_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with their airport, both stored in buckets of the code: no shuffle to join."""
    tables = lake(spark, sf_dir, "immigration", "airport_codes")
    facts = tables["immigration"].select("arrival_id", "airport_code")
    airports = tables["airport_codes"].select("airport_code", "airport_name", "municipality")
    hot = hot_keys(facts, "airport_code", 32)
    stored = [
        write_bucketed(df, scratch(spark, name), name, "airport_code", 32, hot, is_fact)
        for df, name, is_fact in ((facts, "bucketed_facts", True), (airports, "bucketed_airports", False))
    ]
    return bucketed_lookup(*stored, "airport_code")
