"""Queries by name, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL for the same result."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    """All queries by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The SQL of every query whose result SQL can state."""
    return dict(_SQL)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shared_base(spark: SparkSession) -> str:
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    one_machine = spark.sparkContext.master.split("[")[0] == "local"
    if not one_machine and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


def scratch(spark: SparkSession, label: str) -> str:
    """A folder for tables a query writes and reads back.

    It lies in the shared folder the cluster names in `spark.checkpoint.dir`, or in the
    session's warehouse where that is unset; a warehouse on a machine's own disk will not do
    on a cluster. A session has one folder per label: running a
    query again first frees what its last run wrote, and the end of the JVM frees the rest.
    """
    base = _shared_base(spark)
    folder = f"{base.rstrip('/')}/landfall/{spark.sparkContext.applicationId}/{label}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path, True)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/data"
