"""Table profiles and row counts per step."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from landfall.functions.columns import missing


def _per_column(df: DataFrame) -> tuple[list[Column], list[str]]:
    counters = [
        F.count_if(missing(df, name)).alias(f"c{i}") for i, name in enumerate(df.columns)
    ]
    return counters, list(df.columns)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column (NULL, or NaN in a floating column), in one pass."""
    counters, names = _per_column(df)
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, name in enumerate(names)
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, rows, values present and missing, in one pass."""
    counters, names = _per_column(df)
    total = F.col("total")
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(df.schema[i].dataType.simpleString()).alias("data_type"),
            total.alias("row_count"),
            (total - F.col(f"c{i}")).alias("non_null"),
            F.col(f"c{i}").alias("null_count"),
        )
        for i, name in enumerate(names)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *counters)
    return counted.select(F.inline(F.array(*rows)))


def step_counts(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each of a series of filters, in one pass over the input.

    Each step keeps the rows that also passed the steps before it.
    """
    kept = F.lit(True)
    counters, entries = [F.count(F.lit(1)).alias("s0")], [("read", "s0")]
    for i, (name, condition) in enumerate(steps.items(), start=1):
        kept = kept & F.coalesce(condition, F.lit(False))
        counters.append(F.count_if(kept).alias(f"s{i}"))
        entries.append((name, f"s{i}"))
    rows = [
        F.struct(F.lit(name).alias("step"), F.col(column).alias("n")) for name, column in entries
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


class StepCounter:
    """Row counts at marked points of a plan, taken while another action runs.

    Marking a point keeps Catalyst from moving filters below it, so mark only where the
    count is wanted. Counts taken before the last shuffle can be too high when a lost
    executor makes Spark run a map task again; for audited numbers use `step_counts`.
    """

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def mark(self, step: str, df: DataFrame) -> DataFrame:
        """The same frame, counted under this name by the next action on it."""
        self._observations[step] = Observation()
        return df.observe(self._observations[step], F.count(F.lit(1)).alias("n"))

    def counts(self) -> dict[str, int]:
        """Waits for the action, then returns the count of every step."""
        return {step: seen.get["n"] for step, seen in self._observations.items()}
