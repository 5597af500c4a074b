"""Scalar helpers. Every function returns a Column built from Spark built-ins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.schemas import SAS_EPOCH

_FLOATING = (T.DoubleType, T.FloatType)
_DATELIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def named(name: str) -> Column:
    """A column by its exact name, even when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    """Data type of one column, found by Spark's rule that case does not matter."""
    for field in df.schema:
        if field.name == name:
            return field.dataType
    return df.select(named(name)).schema[0].dataType


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is NULL, or NaN in a floating column.

    Written as separate conjuncts of `isNull`/`isnan` because `IS NOT NULL` reaches
    the Parquet scan, while the fused test used by `dropna` stays a row filter.
    """
    column = named(name)
    if isinstance(type_of(df, name), _FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The negation of `missing`, in the form the Parquet reader can use."""
    column = named(name)
    if isinstance(type_of(df, name), _FLOATING):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def null_tokens(column: Column, tokens: Iterable[str]) -> Column:
    """NULL where a text equals one of the tokens that stand for "no value"."""
    return F.when(~column.isin(*tokens), column)


def code_key(column: Column, dtype: T.DataType) -> Column:
    """The text form of a code, so that 1, 1L and 1.0 all meet the key '1'.

    The fact side is always turned into text. Comparing a double with a text column
    would cast the keys to double instead, which fails on keys such as 'ALC'.
    """
    if not isinstance(dtype, T.NumericType):
        return column.cast("string")
    whole = column.try_cast("bigint")
    return F.when(whole == column, whole.cast("string")).otherwise(column.cast("string"))


def day_number(column: Column, epoch: str = SAS_EPOCH) -> Column:
    """Days from the epoch to a date or timestamp."""
    return F.datediff(column.cast("date"), F.lit(epoch).cast("date"))


def day_number_to_date(column: Column, epoch: str = SAS_EPOCH) -> Column:
    """The date that lies `column` days after the epoch."""
    return F.date_add(F.lit(epoch).cast("date"), column.cast("int"))


def days_between(df: DataFrame, start: str, end: str) -> Column:
    """Days from `start` to `end` as a double, for day numbers or for dates.

    NULL on either side gives NULL. Negative spans are kept.
    """
    kinds = [type_of(df, name) for name in (start, end)]
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        return (named(end) - named(start)).cast("double")
    if all(isinstance(kind, _DATELIKE) for kind in kinds):
        return F.datediff(named(end), named(start)).cast("double")
    shown = [kind.simpleString() for kind in kinds]
    raise TypeError(f"{start} and {end} must both be numbers or both be dates, not {shown}")


def us_state_code(iso_country: Column, iso_region: Column) -> Column:
    """'CA' for region 'US-CA'; NULL outside the United States."""
    return F.when(iso_country == "US", F.substring_index(iso_region, "-", -1))


def period_columns(column: Column, grain: str) -> dict[str, Column]:
    """Named key columns for one time grain of a date, timestamp or ISO text."""
    day = column.cast("date")
    grains = {
        "year": {"year": F.year(day)},
        "month": {"month": F.month(day)},
        "year_month": {"year": F.year(day), "month": F.month(day)},
        "day_of_month": {"day_of_month": F.day(day)},
        "day": {"day": day},
    }
    if grain not in grains:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(grains)}")
    return grains[grain]
