"""Projections, filters, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.columns import day_number, day_number_to_date
from landfall.operators import (
    align_to,
    cast_columns,
    distinct_rows,
    drop_missing,
    rename,
    since,
    union_extracts,
    with_duration,
)
from landfall.workloads.frames import items_with_orders, null_if
from landfall.workloads.registry import load, query


def _orders_with_drift(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders, and January again with its columns reversed and one column more."""
    orders = load(spark, sf_dir, "orders")
    january = orders.where(F.month("o_orderdate") == 1)
    return [orders, january.select(*reversed(orders.columns), F.lit(0.0).alias("delete_days"))]


def _twelve_extracts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Orders by month; each extract holds January once more, later ones in another order."""
    orders = load(spark, sf_dir, "orders")
    january = orders.where(F.month("o_orderdate") == 1)
    extracts = []
    for month in range(1, 13):
        own = orders.where(F.month("o_orderdate") == month).unionByName(january)
        names = orders.columns if month % 2 else [*reversed(orders.columns)]
        extra = [F.lit(0.0).alias("delete_days")] if month == 6 else []
        extracts.append(own.select(*names, *extra))
    return extracts


@query("""
select year(o_orderdate)::int as year, month(o_orderdate)::int as month,
       o_orderkey, nullif(o_orderpriority, '5-LOW') as prio
from orders where o_orderstatus = 'F' and o_orderpriority <> '5-LOW'""")
def conform_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unite twelve drifting extracts, drop copies, filter, drop missing, project."""
    rows = distinct_rows(union_extracts(_twelve_extracts(spark, sf_dir)))
    filled = rows.where(F.col("o_orderstatus") == "F").withColumn(
        "prio", null_if(F.col("o_orderpriority"), "5-LOW")
    )
    complete = drop_missing(filled, ["prio"])
    return complete.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "o_orderkey",
        "prio",
    )


@query("""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders union all select * from orders where month(o_orderdate) = 1""")
def union_drifting_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union by name; the extra column of the second extract goes."""
    return union_extracts(_orders_with_drift(spark, sf_dir))


@query("select o_orderkey, o_totalprice, o_custkey from orders")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns in the contract's order."""
    orders = load(spark, sf_dir, "orders")
    drifted = orders.select(*reversed(orders.columns), F.lit(0.0).alias("delete_days"))
    return align_to(drifted, ["o_orderkey", "o_totalprice", "o_custkey"])


@query("""
select distinct * from (select * from orders
  union all select * from orders where month(o_orderdate) = 1)""")
def distinct_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copy of every row over all columns."""
    return distinct_rows(union_extracts(_orders_with_drift(spark, sf_dir)))


@query("select distinct c_nationkey, c_mktsegment from customer")
def distinct_after_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop columns first, then copies."""
    customers = load(spark, sf_dir, "customer")
    return distinct_rows(customers.drop("c_custkey", "c_name", "c_acctbal"))


@query("""
select l_orderkey, l_linenumber,
       date_diff('day', o_orderdate, l_shipdate)::double as stay_duration
from lineitem join orders on l_orderkey = o_orderkey""")
def stay_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between two dates as a double; negative spans stay."""
    timed = with_duration(
        items_with_orders(spark, sf_dir), "o_orderdate", "l_shipdate", "stay_duration"
    )
    return timed.select("l_orderkey", "l_linenumber", "stay_duration")


@query("""
select l_orderkey, l_linenumber,
       case when l_tax < 0.075
            then date_diff('day', o_orderdate, l_shipdate)::double end as stay_duration
from lineitem join orders on l_orderkey = o_orderkey""")
def stay_from_day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from day numbers, with open ends giving NULL."""
    items = items_with_orders(spark, sf_dir)
    numbered = items.withColumns(
        {
            "arrdate": day_number(F.col("o_orderdate")).cast("double"),
            "depdate": F.when(
                F.col("l_tax") < 0.075, day_number(F.col("l_shipdate")).cast("double")
            ),
        }
    )
    timed = with_duration(numbered, "arrdate", "depdate", "stay_duration")
    return timed.select("l_orderkey", "l_linenumber", "stay_duration")


@query("""
select o_orderkey, date_diff('day', date '1960-01-01', o_orderdate::date)::int as day_no,
       o_orderdate::date as day
from orders""")
def day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day numbers since 1960-01-01, and back to dates."""
    numbered = load(spark, sf_dir, "orders").withColumn("day_no", day_number(F.col("o_orderdate")))
    return numbered.select(
        "o_orderkey", "day_no", day_number_to_date(F.col("day_no")).alias("day")
    )


@query("""
select o_orderkey, o_orderdate from orders where o_orderdate >= date '2000-01-01'""")
def since_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on or after a day."""
    return since(load(spark, sf_dir, "orders"), "o_orderdate", "2000-01-01").select(
        "o_orderkey", "o_orderdate"
    )


@query("""
select event_id, strftime(ts, '%Y-%m-%d') as dt from events where ts >= date '2024-01-15'""")
def since_day_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a column that holds ISO dates as text."""
    events = load(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    return since(events, "dt", "2024-01-15")


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_linenumber = 1")
def filter_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality with a number."""
    items = load(spark, sf_dir, "lineitem").where(F.col("l_linenumber") == 1)
    return items.select("l_orderkey", "l_linenumber", "l_quantity")


@query("select c_custkey, c_mktsegment from customer where c_mktsegment = 'BUILDING'")
def filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality with a text."""
    customers = load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return customers.select("c_custkey", "c_mktsegment")


def _orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        null_if(F.col("o_orderpriority"), "5-LOW").alias("p"),
        null_if(F.col("o_orderstatus"), "F").alias("st"),
    )


@query("""
select o_orderkey, o_orderpriority as p, o_orderstatus as st from orders
where o_orderpriority <> '5-LOW' and o_orderstatus <> 'F'""")
def dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows complete in all columns."""
    return drop_missing(_orders_with_nulls(spark, sf_dir))


@query("""
select o_orderkey, o_orderpriority as p, nullif(o_orderstatus, 'F') as st from orders
where o_orderpriority <> '5-LOW'""")
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows complete in one column."""
    return drop_missing(_orders_with_nulls(spark, sf_dir), ["p"])


@query("select l_orderkey, l_linenumber, l_quantity as q from lineitem where l_quantity <> 50")
def dropna_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN counts as missing."""
    quantity = F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(
        F.col("l_quantity")
    )
    items = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", quantity.alias("q")
    )
    return drop_missing(items)


@query("select l_orderkey, l_linenumber, cast(trunc(l_quantity) as bigint) as qty from lineitem")
def cast_to_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles to whole numbers."""
    items = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty")
    )
    return cast_columns(items, {"qty": "bigint"})


@query("select p_partkey, p_name as part_name, p_brand as brand, p_retailprice from part")
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename and drop columns."""
    parts = load(spark, sf_dir, "part").drop("p_type", "p_size")
    return rename(parts, {"p_name": "part_name", "p_brand": "brand"}, strict=True)


@query("select * from orders order by o_orderkey limit 10")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows with the least keys."""
    return load(spark, sf_dir, "orders").orderBy("o_orderkey").limit(10)
