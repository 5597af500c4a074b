"""Bucketed tables: facts and dimensions laid out by one key, joined without a shuffle.

A bucket is one task of the join, so a key with more rows than a bucket should hold is dealt
over several: its facts get a salt, and its dimension row is stored once for each salt. How
many salts a key needs is counted when the facts are written and kept beside them. Only keys
above a bucket's share are counted out, of which there are at most as many as buckets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import named
from landfall.operators.aggregates import count_by
from landfall.sinks.snapshots import _Files

SALT = "bucket_salt"
_ABOUT = "_bucket_layout.json"


def hot_keys(df: DataFrame, key: str, buckets: int) -> list[tuple[object, int]]:
    """Keys with more rows than an even bucket, and into how many parts each is dealt."""
    counted = count_by(df.where(named(key).isNotNull()), key)
    share = max(1, -(-df.count() // buckets))
    found = counted.where(F.col("n") > share).collect()
    return [(row[0], -(-row[1] // share)) for row in found]


def _parts(key: str, hot: Sequence[tuple[object, int]]) -> Column:
    """How many parts the key of a row is dealt into."""
    parts = F.lit(1)
    for value, number in hot:
        parts = F.when(named(key) == F.lit(value), F.lit(number)).otherwise(parts)
    return parts


def write_bucketed(
    df: DataFrame,
    path: str,
    name: str,
    key: str,
    buckets: int,
    hot: Sequence[tuple[object, int]] = (),
    is_fact: bool = True,
) -> DataFrame:
    """Write a table in buckets of (key, salt) below a path, register it under a name and open it.

    `hot` is what `hot_keys` found in the facts. Facts of a hot key get one of its salts, by
    all their columns, and those of a missing key any; a dimension row is stored with all
    salts of its key. Every bucket is one sorted file.
    """
    if is_fact:
        spread = F.when(named(key).isNull(), F.lit(buckets)).otherwise(_parts(key, hot))
        salted = df.withColumn(SALT, F.pmod(F.xxhash64(*[named(c) for c in df.columns]), spread).cast("int"))
    else:
        salted = df.withColumn(SALT, F.explode(F.sequence(F.lit(0), _parts(key, hot) - 1)))
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    laid_out = salted.repartition(buckets, named(key), named(SALT))
    writer = laid_out.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).mode("overwrite")
    writer.option("path", path).saveAsTable(name)
    files = _Files(spark, path)
    if files.exists(_ABOUT):
        files.delete(_ABOUT)
    about = {"key": key, "buckets": buckets, "schema": salted.schema.jsonValue()}
    files.write(_ABOUT, json.dumps(about))
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Register a bucketed table that another session has written, and open it."""
    about = json.loads(_Files(spark, path).read(_ABOUT))
    schema = T.StructType.fromJson(about["schema"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"`{about['key']}`, `{SALT}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'"
        f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {about['buckets']} BUCKETS"
    )
    return spark.table(name)


def bucketed_lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts with the columns of a dimension that is bucketed alike; neither side moves.

    Facts without a partner, or with a NULL key, stay.
    """
    marked = dimension.withColumnsRenamed({key: "__bucket_key", SALT: "__bucket_salt"})
    same = (named(key) == F.col("__bucket_key")) & (F.col(SALT) == F.col("__bucket_salt"))
    return facts.join(marked, same, "left").drop("__bucket_key", "__bucket_salt", SALT)
