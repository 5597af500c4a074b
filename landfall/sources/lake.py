"""Opening a lake for DataFrame and Spark SQL users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landfall.schemas import LAKE_SCHEMAS
from landfall.sinks.snapshots import read_snapshot, snapshot_versions


def table_path(base: str, table: str) -> str:
    """Folder of one table; `base` is any Hadoop URI."""
    return f"{base.rstrip('/')}/{table}"


def open_lake(
    spark: SparkSession,
    base: str,
    tables: Iterable[str] | None = None,
    register: bool = True,
    arrival_date: bool = False,
) -> dict[str, DataFrame]:
    """The lake's tables by name, also registered as temporary views for `spark.sql`.

    The fixed schemas are used, so no file footer is read to infer types, and partition
    values keep their type ('1234' stays a city, month stays an integer). `arrival_date`
    adds that column to the fact table of a lake that was built to keep it. A table with
    versions is opened at its newest and stays there.
    """
    opened = {}
    for table in LAKE_SCHEMAS if tables is None else tables:
        schema = LAKE_SCHEMAS[table]
        if arrival_date and table == "immigration":
            schema = T.StructType([*schema, T.StructField("arrival_date", T.DateType())])
        path = table_path(base, table)
        if snapshot_versions(spark, path):
            opened[table] = read_snapshot(spark, path, schema=schema)
        else:
            opened[table] = spark.read.schema(schema).parquet(path)
        if register:
            opened[table].createOrReplaceTempView(table)
    return opened
