"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole `documents` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """A text column in which NULL is the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`, removed when the session's JVM ends.

    Where that is unset, the folder lies in the session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts lineage in a way that survives lost executors, and gives Spark the table's
    true size, so that it broadcasts a small one by itself and never a large one.
    """
    folder = shared_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(f"{folder}/data")
    table = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/data")
    _FOLDERS[table] = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Free stored tables that nothing will read again, before the JVM ends."""
    for table in tables:
        if folder := _FOLDERS.pop(table, None):
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often `use` names it.

    A plain column that a filter above it names is written into the filter by the optimizer;
    inside a lambda that would compute it again for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
