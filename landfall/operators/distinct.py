"""De-duplication over all columns, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import named

_ROWS, _FIRST = "__rows", "__first"


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of every row, compared over all columns.

    Spark drops copies inside each map task before the shuffle, so one row repeated
    a billion times costs one row per task. Filters written after this call are moved
    below it by Catalyst, because all columns are grouping keys.
    """
    return df.dropDuplicates()


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    repeated: str = "first",
) -> DataFrame:
    """At most one row for each key, so that a lookup by it cannot multiply facts.

    With `repeated="first"` the first row in `order` stays, and among equals the first by all
    columns, NULL first; with "error" a repeated key raises when the result is read; with
    "all" nothing is done. Rows with a NULL key match no fact and count as one key here. One
    aggregation, combined map-side.
    """
    if repeated == "all":
        return df
    if repeated not in ("first", "error"):
        raise ValueError(f"unknown choice {repeated!r}; use 'first', 'error' or 'all'")
    ranks = [rank.alias(f"__rank_{i}") for i, rank in enumerate(order)]
    whole = F.struct(*[named(c) for c in df.columns]).alias("row")
    least = F.min(F.struct(*ranks, whole)).alias(_FIRST)
    first = df.groupBy(*[named(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        least, F.count(F.lit(1)).alias(_ROWS)
    )
    if repeated == "error":
        key = F.concat_ws(", ", *[F.col(f"__key_{i}").cast("string") for i in range(len(keys))])
        message = F.concat(F.lit(f"{', '.join(keys)} occurs more than once: "), key)
        ok = F.when(F.col(_ROWS) == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        first = first.where(ok)
    return first.select(f"{_FIRST}.row.*")
