"""Lookups from facts into code maps and dimensions.

No side is ever forced into a broadcast. Spark broadcasts a side only below
`spark.sql.autoBroadcastJoinThreshold`, by estimate when planning and by measured
shuffle size at run time (AQE). Past that size the join shuffles, and AQE splits a
hot key on the fact side over several tasks (left joins allow that split). Two such joins
in a row on one key share a shuffle, and AQE then splits neither unless
`spark.sql.adaptive.forceOptimizeSkewedJoin` is set, which a large run needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import code_key, named, type_of
from landfall.operators.aggregates import count_by
from landfall.schemas import PLACEHOLDER_PATTERN

_KEY = "__lookup_key"


def decode(
    df: DataFrame,
    column: str,
    code_map: DataFrame,
    out: str,
    placeholder_out: str | None = None,
) -> DataFrame:
    """Add the text that a code map (key, value) holds for a code column.

    Rows with an unknown or missing code stay, with NULL. `placeholder_out` names an
    extra flag that marks descriptions such as "No PORT Code (x)".
    """
    key = code_key(named(column), type_of(df, column))
    codes = code_map.select(F.col("key").alias(_KEY), F.col("value").alias(out))
    decoded = df.join(codes, key == F.col(_KEY), "left").drop(_KEY)
    if placeholder_out:
        flag = F.coalesce(named(out).rlike(PLACEHOLDER_PATTERN), F.lit(False))
        decoded = decoded.withColumn(placeholder_out, flag)
    return decoded


def left_lookup(
    df: DataFrame, dimension: DataFrame, on: Sequence[tuple[str | Column, str]]
) -> DataFrame:
    """Left join on (left key, right key) pairs; the right keys are dropped.

    A dimension with several rows per key repeats the left row, as in SQL.
    """
    marks = {right: f"{_KEY}_{i}" for i, (_, right) in enumerate(on)}
    right_side = dimension.withColumnsRenamed(marks)
    condition = [
        (named(left) if isinstance(left, str) else left) == F.col(marks[right])
        for left, right in on
    ]
    return df.join(right_side, condition, "left").drop(*marks.values())


def _keyed_counts(fact: DataFrame, dimension: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Fact rows per key, with a flag that says whether the dimension has the key.

    Counting per key first means that the join moves one row per key, however the fact
    rows are spread over the keys.
    """
    left, right = on
    counted = count_by(fact, left, out="facts")
    key = code_key(named(left), type_of(counted, left))
    known = dimension.select(
        code_key(named(right), type_of(dimension, right)).alias(_KEY)
    ).distinct()
    return counted.join(known, key == F.col(_KEY), "left").withColumn(
        "is_matched", F.col(_KEY).isNotNull()
    )


def key_coverage(fact: DataFrame, dimension: DataFrame, on: tuple[str, str]) -> DataFrame:
    """One row: fact rows in all, with a partner in the dimension, and without one."""
    counts = _keyed_counts(fact, dimension, on)
    facts = F.coalesce(F.sum("facts"), F.lit(0))
    matched = F.coalesce(F.sum(F.when(F.col("is_matched"), F.col("facts"))), F.lit(0))
    return counts.agg(
        facts.alias("facts"), matched.alias("matched"), (facts - matched).alias("unmatched")
    )


def unmatched_keys(fact: DataFrame, dimension: DataFrame, on: tuple[str, str]) -> DataFrame:
    """The keys the dimension lacks, with the number of fact rows that use them."""
    counts = _keyed_counts(fact, dimension, on)
    return counts.where(~F.col("is_matched")).select(named(on[0]), "facts")
