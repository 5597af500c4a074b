"""Projections, filters and set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import days_between, named, present, type_of


def align_to(df: DataFrame, contract: Sequence[str]) -> DataFrame:
    """Exactly the contract's columns, in its order; extra columns go.

    A column the frame lacks is an error that names it.
    """
    own = {name.casefold(): name for name in df.columns}
    lacking = [name for name in contract if name.casefold() not in own]
    if lacking:
        raise ValueError(f"contract columns not found: {', '.join(lacking)}")
    if list(contract) == df.columns:
        return df
    kept = df.select([named(own[name.casefold()]) for name in contract])
    return kept if kept.columns == list(contract) else kept.toDF(*contract)


def union_extracts(
    frames: Iterable[DataFrame], contract: Sequence[str] | None = None
) -> DataFrame:
    """All rows of all frames; the first frame's columns are the contract by default."""
    frames = list(frames)
    if not frames:
        raise ValueError("no extracts to unite")
    contract = contract or frames[0].columns
    aligned = [align_to(frame, contract) for frame in frames]
    while len(aligned) > 1:  # in pairs, so that no plan is analysed more often than needed
        pairs = [aligned[i : i + 2] for i in range(0, len(aligned), 2)]
        aligned = [reduce(DataFrame.unionByName, pair) for pair in pairs]
    return aligned[0]


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows that hold a value in every named column (in all columns by default).

    Same rows as `dropna`, but the null tests reach the Parquet scan. An empty list names no
    column, so all rows stay.
    """
    tests = [present(df, name) for name in (df.columns if subset is None else subset)]
    return df.where(reduce(and_, tests)) if tests else df


def rename(df: DataFrame, mapping: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rename columns; unknown names are ignored unless `strict`."""
    unknown = [name for name in mapping if name not in df.columns]
    if strict and unknown:
        raise ValueError(f"columns to rename not found: {', '.join(unknown)}")
    return df.withColumnsRenamed(dict(mapping))


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast named columns in one projection. Under ANSI, values that do not fit raise."""
    return df.withColumns({name: named(name).cast(dtype) for name, dtype in types.items()})


def with_duration(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """Add the number of days from `start` to `end` as a double."""
    return df.withColumn(out, days_between(df, start, end))


def since(df: DataFrame, column: str, day: str | dt.date) -> DataFrame:
    """Rows on or after a day.

    Date and timestamp columns are compared with a literal of their own type, which
    the Parquet scan can use. Text has to hold ISO dates (2000-01-31, with or without a
    time); it is compared as text, which the scan can use too, and also as a date, so that
    under ANSI a text that is no date raises.
    """
    dtype = type_of(df, column)
    bound = F.lit(str(day)).cast("date")
    if isinstance(dtype, T.StringType):
        return df.where((named(column) >= str(day)) & (F.to_date(named(column)) >= bound))
    return df.where(named(column) >= bound.cast(dtype))
