"""Grouped counts, top-k and duration statistics.

All of these aggregate map-side first, so a key that holds a third of the rows
reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.columns import named, present

_DAYS, _ROWS, _UPTO, _ALL = "__days", "__rows", "__upto", "__all"


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*[named(key) for key in keys]).agg(F.count(F.lit(1)).alias(out))


def top_k(df: DataFrame, keys: Sequence[str], k: int, out: str = "n") -> DataFrame:
    """The k keys with the most rows; ties are broken by key, so the answer is fixed.

    Sort plus limit is one TakeOrderedAndProject: k rows per task, no full sort.
    """
    counted = count_by(df, *keys, out=out)
    return counted.orderBy(named(out).desc(), *[named(key).asc() for key in keys]).limit(k)


def average_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    count_out: str | None = None,
) -> DataFrame:
    """Mean of one column per key, rounded to six places, with the number of values."""
    measures: list[Column] = [F.round(F.avg(named(value)), 6).alias(out)]
    if count_out:
        measures.append(F.count(named(value)).alias(count_out))
    return df.groupBy(*[named(key) for key in keys]).agg(*measures)


def stay_stats(
    df: DataFrame, keys: Sequence[str], duration: str = "stay_duration"
) -> DataFrame:
    """Mean, exact median, extremes and count of a duration per key.

    Missing durations, NaN among them, count nowhere. Rows are first counted per key and
    duration, which Spark combines map-side. The median is read off the running count over
    the durations in order, a sort that can spill, so any number of them will do.
    """
    known = df.withColumn(_DAYS, F.when(present(df, duration), named(duration)))
    counted = count_by(known, *keys, _DAYS, out=_ROWS)
    days, rows = F.col(_DAYS), F.when(F.col(_DAYS).isNotNull(), F.col(_ROWS))
    key_columns = [named(key) for key in keys]
    in_order = Window.partitionBy(*key_columns).orderBy(days.asc_nulls_last())
    upto = F.sum(rows).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumns(
        {_UPTO: upto, _ALL: F.sum(rows).over(Window.partitionBy(*key_columns))}
    )
    lower = F.min(F.when(2 * F.col(_UPTO) >= F.col(_ALL), days))
    upper = F.min(F.when(2 * F.col(_UPTO) > F.col(_ALL), days))
    number = F.coalesce(F.sum(rows), F.lit(0))
    return placed.groupBy(*key_columns).agg(
        F.round(F.try_divide(F.sum(days * rows), number), 6).alias("avg_days"),
        ((lower + upper) / 2).cast("double").alias("median_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        number.alias("n"),
    )
