"""Checks and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators import quality as checks
from landfall.operators import profiling
from landfall.sinks import write_table
from landfall.workloads.frames import null_if
from landfall.workloads.registry import load, query, scratch


def _check_rows(parts: list[str]) -> str:
    """SQL for check rows from selects that give name, target, violations and rows."""
    united = " union all ".join(parts)
    return f"""
select check_name, target, violations::bigint as violations,
       rows_checked::bigint as rows_checked, violations = 0 as passed
from ({united}) as t(check_name, target, violations, rows_checked)"""


@query(
    _check_rows(
        [
            f"""select 'rule', '{name}', count(*) filter (not coalesce({rule}, false)), count(*)
                from (select l_quantity, l_linenumber, l_extendedprice, l_discount,
                             nullif(l_tax, 0.08) as l_tax from lineitem)"""
            for name, rule in {
                "quantity_over_line": "l_quantity > l_linenumber",
                "price_covers_parts": "l_extendedprice >= l_quantity + l_discount",
                "tax_below_discount": "l_tax < l_discount",
                "quantity_at_least_two": "l_quantity >= 2",
            }.items()
        ]
    )
)
def check_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four row rules in one pass; an unknown outcome is a violation."""
    items = load(spark, sf_dir, "lineitem").withColumn("l_tax", null_if(F.col("l_tax"), 0.08))
    return checks.check_rules(
        items,
        {
            "quantity_over_line": "l_quantity > l_linenumber",
            "price_covers_parts": "l_extendedprice >= l_quantity + l_discount",
            "tax_below_discount": "l_tax < l_discount",
            "quantity_at_least_two": "l_quantity >= 2",
        },
    )


@query(
    _check_rows(
        [
            """select 'not_empty', '*', case when count(*) = 0 then 1 else 0 end,
                      least(count(*), 1) from orders"""
        ]
    )
)
def check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has rows."""
    return checks.check_not_empty(load(spark, sf_dir, "orders"))


@query(
    _check_rows(
        ["select 'not_empty', '*', 1, count(*) from orders where o_totalprice < 0"]
    )
)
def check_not_empty_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection without rows fails the check."""
    return checks.check_not_empty(load(spark, sf_dir, "orders").where("o_totalprice < 0"))


@query(
    _check_rows(
        [
            """select 'min_distinct', 'event_type',
                      (count(distinct event_type) < 2)::int, count(*) from events""",
            """select 'min_distinct', 'day',
                      (count(distinct ts::date) < 2)::int, count(*) from events""",
            "select 'min_distinct', 'constant', 1, count(*) from events",
        ]
    )
)
def check_min_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several values in two columns, one value in a third."""
    events = load(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").alias("day"), F.lit("x").alias("constant")
    )
    return checks.check_min_distinct(events, ["event_type", "day", "constant"])


@query(
    _check_rows(
        [
            """select 'min_distinct', 'event_type',
                      (count(distinct event_type) < 5)::int, count(*) from events""",
            """select 'min_distinct', 'day',
                      (count(distinct ts::date) < 5)::int, count(*) from events""",
        ]
    )
)
def check_min_distinct_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least five values."""
    events = load(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").alias("day")
    )
    return checks.check_min_distinct(events, ["event_type", "day"], at_least=5)


_NAN_RULES = {
    "quantity_over_one": "q > 1",
    "quantity_open_or_positive": "q IS NULL OR q > 0",
    "line_positive": "l_linenumber > 0",
}
_NAN_SQL = [
    f"""select 'rule', '{name}', count(*) filter (not coalesce({rule}, false)), count(*)
        from (select nullif(l_quantity, 50) as q, l_linenumber from lineitem)"""
    for name, rule in _NAN_RULES.items()
]


def _items_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose quantity is NaN where it was 50."""
    quantity = F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    items = load(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", quantity.alias("q"))


@query(_check_rows(_NAN_SQL))
def check_rules_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is a missing value in every rule."""
    return checks.check_rules(_items_with_nan(spark, sf_dir), _NAN_RULES)


@query(_check_rows(_NAN_SQL))
def check_rules_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules counted while the rows are written."""
    items = _items_with_nan(spark, sf_dir)
    path = scratch(spark, "items_checked")
    report = write_table(items, path, checks=checks.rules(_NAN_RULES))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_checked"))
    found = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"), F.lit(target).alias("target"),
                F.lit(violations).cast("bigint").alias("violations"), "rows_checked",
                F.lit(violations == 0).alias("passed"),
            )
            for name, target, violations in report.checks
        ]
    )
    return rows.select(F.inline(found))


@query(
    _check_rows(
        [
            f"""select 'min_distinct', '{name}', (count(distinct {value}) < 51)::int, count(*)
                from lineitem"""
            for name, value in {"q": "nullif(l_quantity, 50)", "l_orderkey": "l_orderkey"}.items()
        ]
    )
)
def check_min_distinct_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is not one of the different values; all columns in one pass."""
    items = _items_with_nan(spark, sf_dir)
    return checks.check_min_distinct(items, ["q", "l_orderkey"], at_least=51)


@query(
    _check_rows(
        [
            """select 'not_null', 'o_orderkey', count(*) filter (o_orderkey is null), count(*)
               from orders""",
            """select 'not_null', 'p', count(*) filter (o_orderpriority = '5-LOW'), count(*)
               from orders""",
        ]
    )
)
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values in named columns."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", null_if(F.col("o_orderpriority"), "5-LOW").alias("p")
    )
    return checks.check_not_null(orders, ["o_orderkey", "p"])


@query(
    _check_rows(
        [
            """select 'unique', 'l_orderkey, l_linenumber', count(*) filter (n > 1), sum(n)
               from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)"""
        ]
    )
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are not unique."""
    return checks.check_unique(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys are not unique."""
    return checks.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
with n as (select count(*) as row_count from orders)
select t.*, case when data_type is not null then row_count end as row_count,
       case when data_type is not null then row_count - nulls end as non_null,
       case when data_type is not null then nulls end as null_count
from n, (values ('o_orderkey', 'bigint', 'bigint', true),
                ('o_custkey', 'bigint', 'bigint', true),
                ('o_orderstatus', 'string', 'string', true),
                ('o_totalprice', 'float', 'double', false),
                ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', true),
                ('o_clerk', 'string', null, false),
                ('o_orderpriority', null, 'string', false))
  as t(column_name, expected_type, data_type, passed),
  lateral (select count(*) filter (t.column_name = 'o_orderpriority'
                                   and o_orderpriority = '5-LOW') as nulls from orders)""")
def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted against found columns and types, with the rows and missing values of each."""
    expected = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.FloatType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_clerk", T.StringType()),
        ]
    )
    orders = load(spark, sf_dir, "orders")
    given = orders.withColumn("o_orderpriority", null_if(F.col("o_orderpriority"), "5-LOW"))
    return checks.check_columns(given, expected)


@query(
    _check_rows(
        [
            """select 'row_count', 'orders_kept', count(*) filter (o_orderstatus <> 'F'), count(*)
               from orders"""
        ]
    )
)
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a target lost against its source."""
    orders = load(spark, sf_dir, "orders")
    return checks.check_row_count(
        orders, orders.where(F.col("o_orderstatus") == "F"), "orders_kept"
    )


@query("""
select 'o_orderkey' as column_name, count(*) filter (o_orderkey is null) as null_count from orders
union all select 'p', count(*) filter (o_orderpriority = '5-LOW') from orders
union all select 's', count(*) filter (o_orderstatus = 'F') from orders
union all select 'v', count(*) filter (o_totalprice < 100000 or o_totalprice > 400000)
  from orders""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values per column; NaN counts."""
    price = F.col("o_totalprice")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        null_if(F.col("o_orderpriority"), "5-LOW").alias("p"),
        null_if(F.col("o_orderstatus"), "F").alias("s"),
        F.when(price < 100000, F.lit(float("nan"))).when(price <= 400000, price).alias("v"),
    )
    return profiling.null_profile(orders)


@query("""
select position::int as position, column_name, data_type, row_count,
       row_count - null_count as non_null, null_count
from (select 0 as position, 'c_custkey' as column_name, 'bigint' as data_type,
             count(*) as row_count, 0 as null_count from customer
      union all select 1, 'c_nationkey', 'int', count(*), 0 from customer
      union all select 2, 'segment', 'string', count(*),
                       count(*) filter (c_mktsegment = 'BUILDING') from customer
      union all select 3, 'c_acctbal', 'double', count(*), 0 from customer)""")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, rows and missing values per column."""
    customers = load(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        null_if(F.col("c_mktsegment"), "BUILDING").alias("segment"),
        "c_acctbal",
    )
    return profiling.profile(customers)


@query("""
select 'read' as step, count(*) as n from orders
union all select 'filter', count(*) from orders where o_orderstatus = 'F'
union all select 'dropna', count(*) from orders
  where o_orderstatus = 'F' and o_orderpriority <> '5-LOW'""")
def step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after each step, in one pass."""
    return profiling.step_counts(
        load(spark, sf_dir, "orders"),
        {
            "filter": F.col("o_orderstatus") == "F",
            "dropna": null_if(F.col("o_orderpriority"), "5-LOW").isNotNull(),
        },
    )
