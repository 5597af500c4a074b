"""Sources and sinks: every query writes given data, reads it back and returns it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import plans
from landfall.operators import count_by, decode
from landfall.schemas import LAKE_SCHEMAS, MONTHS
from landfall.sinks import write_csv, write_table
from landfall.sources import (
    monthly_paths,
    open_lake,
    read_code_map,
    read_csv,
    read_extract,
    read_extracts,
)
from landfall.workloads import frames
from landfall.workloads.flows import (
    CONFORMED_AIRPORTS,
    CONFORMED_ARRIVALS,
    CONFORMED_DEMOGRAPHICS,
)
from landfall.workloads.registry import load, query, scratch


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )


@query("""
select o_orderstatus, count(*) as n from orders where month(o_orderdate) = 3 group by 1""")
def pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by month; one month read back touches one folder."""
    path = scratch(spark, "orders_by_month")
    write_table(_dated_orders(spark, sf_dir), path, ["month"])
    return count_by(spark.read.parquet(path).where(F.col("month") == 3), "o_orderstatus")


@query("""
select o_orderstatus, count(*) as n from orders
where year(o_orderdate) = 1996 and month(o_orderdate) = 3 group by 1""")
def pruned_read_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by year, then month."""
    path = scratch(spark, "orders_by_year_month")
    write_table(_dated_orders(spark, sf_dir), path, ["year", "month"])
    one_month = spark.read.parquet(path).where("year = 1996 and month = 3")
    return count_by(one_month, "o_orderstatus")


@query("""
select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment from customer""")
def partition_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing partition value survives the round trip."""
    path = scratch(spark, "customers_by_segment")
    customers = load(spark, sf_dir, "customer").select(
        "c_custkey", frames.null_if(F.col("c_mktsegment"), "BUILDING").alias("segment")
    )
    write_table(customers, path, ["segment"])
    return spark.read.parquet(path)


@query("""
select month(o_orderdate)::int as month,
       count(*) * case when month(o_orderdate) = 3 then 2 else 1 end as n
from orders group by month(o_orderdate)""")
def partition_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month replaced, the others untouched."""
    path = scratch(spark, "orders_refreshed")
    orders = _dated_orders(spark, sf_dir)
    write_table(orders, path, ["month"])
    march = orders.where(F.col("month") == 3)
    write_table(march.unionByName(march), path, ["month"], mode="partitions")
    return count_by(spark.read.parquet(path), "month")


@query("""
select year(o_orderdate)::int as year, month(o_orderdate)::int as month,
       count(*) * case when year(o_orderdate) = 1996 and month(o_orderdate) = 3 then 2 else 1 end
         as n
from orders group by year(o_orderdate), month(o_orderdate)""")
def partition_refresh_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of one year replaced; the same month of other years stays."""
    path = scratch(spark, "orders_refreshed_by_year")
    orders = _dated_orders(spark, sf_dir)
    write_table(orders, path, ["year", "month"])
    march = orders.where("year = 1996 and month = 3")
    write_table(march.unionByName(march), path, ["year", "month"], mode="partitions")
    return count_by(spark.read.parquet(path), "year", "month")


@query("select count(*) as rows_written, count(*) as rows_read from orders")
def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted on the way into the table, and rows found in it."""
    path = scratch(spark, "orders_counted")
    report = write_table(_dated_orders(spark, sf_dir), path, ["month"])
    return spark.read.parquet(path).agg(
        F.lit(report.rows).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read"),
    )


@query("select * from part")
def csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ';' table."""
    path = scratch(spark, "parts_csv")
    parts = load(spark, sf_dir, "part")
    write_csv(parts, path, sep=";")
    return read_csv(spark, path, parts.schema, sep=";")


@query("""
select s_suppkey, 'The "' || s_name || '", supplier' as s_name, s_acctbal from supplier""")
def csv_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ',' table with quotes and commas in its texts, its columns read in another order."""
    path = scratch(spark, "suppliers_csv")
    suppliers = load(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(F.lit('The "'), F.col("s_name"), F.lit('", supplier')).alias("s_name"),
        "s_acctbal",
    )
    write_csv(suppliers.select("s_acctbal", "s_name", "s_suppkey"), path)
    return read_csv(spark, path, suppliers.schema)


@query("""
select o_orderkey, nullif(nullif(o_orderpriority, '5-LOW'), '1-URGENT') as o_orderpriority
from orders""")
def csv_na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand for a missing value."""
    path = scratch(spark, "orders_csv")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema, na_tokens=("", "5-LOW", "1-URGENT"))


@query("""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders""")
def monthly_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve extracts found by month name; June has columns the others lack."""
    base = scratch(spark, "monthly")
    names = F.element_at(F.array(*[F.lit(month) for month in MONTHS]), F.month("o_orderdate"))
    orders = load(spark, sf_dir, "orders").withColumn("name", names).drop("o_orderdate")
    write_table(orders.where(F.col("name") != "jun"), base, ["name"])
    june = orders.where(F.col("name") == "jun").drop("name")
    write_table(june.select(F.lit(0.0).alias("delete_days"), "*"), f"{base}/name=jun")
    return read_extracts(spark, monthly_paths(base + "/name={month}"))


@query("select c_custkey, c_name, c_acctbal from customer")
def extract_in_other_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract in a format named by the caller."""
    path = scratch(spark, "customers_orc")
    load(spark, sf_dir, "customer").write.orc(path)
    return read_extract(spark, path, fmt="orc").select("c_custkey", "c_name", "c_acctbal")


@query("""
select event_id, unnest(json_keys(props)) as key,
       json_extract_string(props, unnest(json_keys(props))) as value
from events""")
def code_map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects held in a column, as keys and values."""
    entries = F.from_json("props", "map<string,string>")
    return load(spark, sf_dir, "events").select(
        "event_id", F.explode(entries).alias("key", "value")
    )


def _code_map(rows: DataFrame, key: str, value: str, label: str) -> DataFrame:
    """Two columns as a JSON code map with an object per line, read back as a table."""
    path = scratch(rows.sparkSession, label)
    _write_code_map(rows, key, value, path)
    return read_code_map(rows.sparkSession, path, pattern="*.txt", by_line=True)


def _write_code_map(rows: DataFrame, key: str, value: str, path: str) -> None:
    entry = F.create_map(F.col(key).cast("string"), F.col(value))
    rows.select(F.to_json(entry).alias("value")).write.text(path)


@query("""
select o_orderkey, c_name as customer from orders left join customer on o_custkey = c_custkey""")
def code_map_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code map of all customers, an object per line, used to decode every order."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    codes = _code_map(load(spark, sf_dir, "customer"), "c_custkey", "c_name", "customer_codes")
    return decode(orders, "o_custkey", codes, "customer").drop("o_custkey")


@query("""
select n_nationkey::varchar as key, n_name as value, count(c_custkey) as customers
from nation left join customer on n_nationkey = c_nationkey group by 1, 2""")
def published_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code map published as a lake table and joined from there."""
    base = scratch(spark, "lake_of_codes")
    nations = _code_map(load(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation_codes")
    write_table(nations, f"{base}/address_desc")
    codes = open_lake(spark, base, ["address_desc"], register=False)["address_desc"]
    counted = count_by(load(spark, sf_dir, "customer"), "c_nationkey", out="customers")
    keyed = counted.select(
        F.col("c_nationkey").cast("string").alias("key"), F.col("customers")
    )
    return codes.join(keyed, "key", "left").select(
        "key", "value", F.coalesce("customers", F.lit(0)).alias("customers")
    )


def _lake_sources(
    spark: SparkSession, sf_dir: str, label: str, tables: tuple[str, ...], gaps: bool = False
) -> plans.LakeSources:
    """Raw files for the named lake tables, written from the given ones.

    With `gaps`, missing numbers are the text NA and airport names hold a line break.
    """
    base = scratch(spark, label)
    if "immigration" in tables:
        rows = frames.raw_arrivals(spark, sf_dir)
        names = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.col("i94mon").cast("int"))
        write_table(rows.withColumn("name", names), f"{base}/arrivals", ["name"])
    if "temperature" in tables:
        readings = frames.raw_temperature(spark, sf_dir)
        if gaps:
            numbers = ("AverageTemperature", "AverageTemperatureUncertainty")
            readings = readings.withColumns(
                {c: F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in numbers}
            )
        write_csv(readings, f"{base}/temperature")
    if "airport_codes" in tables:
        airports = frames.raw_airports(spark, sf_dir)
        if gaps:
            airports = airports.withColumns(
                {
                    "name": F.concat("name", F.lit("\nsecond line")),
                    "iata_code": F.coalesce("iata_code", F.lit("NA")),
                }
            )
        write_csv(airports, f"{base}/airports")
    if "demographics" in tables:
        write_csv(frames.raw_demographics(spark, sf_dir), f"{base}/demographics", sep=";")
    if any(name.endswith("_desc") for name in tables):
        _write_code_map(load(spark, sf_dir, "nation"), "n_nationkey", "n_name", f"{base}/codes")
    return plans.LakeSources(
        arrivals=monthly_paths(base + "/arrivals/name={month}"),
        temperature=f"{base}/temperature",
        airports=f"{base}/airports",
        demographics=f"{base}/demographics",
        address_codes=f"{base}/codes",
        port_codes=f"{base}/codes",
        visa_codes=f"{base}/codes",
        from_day="2024-01-10",
        code_map_pattern="*.txt",
        code_maps_by_line=True,
        na_tokens=("", "NA") if gaps else ("",),
        multi_line=("airport_codes",) if gaps else (),
    )


def _built(
    spark: SparkSession, sf_dir: str, label: str, tables: tuple[str, ...], gaps: bool = False
) -> dict[str, DataFrame]:
    """The named tables of a lake built from raw files, as read back from it."""
    base = scratch(spark, f"{label}_lake")
    sources = _lake_sources(spark, sf_dir, f"{label}_raw", tables, gaps)
    plans.build_lake(spark, sources, base, tables)
    return open_lake(spark, base, tables, register=False)


_LAKE = f"""
with {frames.RAW_ARRIVALS}, {frames.RAW_TEMPERATURE}, {frames.AIRPORTS},
immigration as (
  select i94yr::int as year, i94mon::int as month, i94port as airport_code
  from (select distinct * from raw_arrivals)
  where i94mode = 1 and i94port is not null and i94bir is not null)"""


@query(f"""
{_LAKE}
select 'immigration' as table_name, count(*) as n from immigration
union all select 'temperature', count(*) from raw_temperature
  where avg_temperature is not null and avg_temperature_uncert is not null
    and country = 'United States' and dt >= '2024-01-10'
union all select 'airport_codes', count(*) from airports
union all select 'demographics', count(*) from supplier
  where floor(s_acctbal) <> 0
    and s_suppkey in (select l_suppkey from lineitem where l_linenumber <> 7)
union all select t, count(*) from nation,
  (values ('address_desc'), ('airport_desc'), ('visacode_desc')) as m(t) group by t""")
def build_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on raw files; rows of every table as read back from the lake."""
    tables = _built(spark, sf_dir, "whole", tuple(LAKE_SCHEMAS))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    united = counts[0]
    for one in counts[1:]:
        united = united.unionByName(one)
    return united


@query(CONFORMED_ARRIVALS)
def built_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows and columns of the fact table in a built lake."""
    return _built(spark, sf_dir, "facts", ("immigration",))["immigration"]


@query(CONFORMED_AIRPORTS)
def built_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the airport table in a built lake."""
    return _built(spark, sf_dir, "airports", ("airport_codes",))["airport_codes"]


@query(CONFORMED_DEMOGRAPHICS)
def built_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the demographics table in a built lake."""
    return _built(spark, sf_dir, "people", ("demographics",))["demographics"]


@query(f"""
with {frames.RAW_TEMPERATURE}, {frames.AIRPORTS}
select 'temperature' as table_name, city as name, dt as key, avg_temperature as number
from raw_temperature
where avg_temperature is not null and avg_temperature_uncert is not null
  and country = 'United States' and dt >= '2024-01-10'
union all
select 'airport_codes', airport_name || chr(10) || 'second line', airport_code, elevation_ft
from airports""")
def built_from_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake from CSV files with NA for missing values and line breaks inside quotes."""
    lake = _built(spark, sf_dir, "gaps", ("temperature", "airport_codes"), gaps=True)
    readings = lake["temperature"].select(
        F.lit("temperature").alias("table_name"), F.col("city").alias("name"),
        F.col("dt").alias("key"), F.col("avg_temperature").alias("number"),
    )
    return readings.unionByName(
        lake["airport_codes"].select(
            F.lit("airport_codes").alias("table_name"), F.col("airport_name").alias("name"),
            F.col("airport_code").alias("key"), F.col("elevation_ft").alias("number"),
        )
    )


@query(f"""
{_LAKE}
select year, month, count(*) as arrivals, count(distinct airport_code) as ports
from immigration group by 1, 2""")
def lake_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free SQL over the views of an opened lake."""
    base = scratch(spark, "sql_lake")
    sources = _lake_sources(spark, sf_dir, "sql_raw", ("immigration",))
    plans.build_lake(spark, sources, base, tables=["immigration"])
    open_lake(spark, base, ["immigration"])
    return spark.sql("""
        SELECT year, month, count(*) AS arrivals, count(DISTINCT airport_code) AS ports
        FROM immigration GROUP BY year, month
    """)
