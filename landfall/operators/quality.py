"""Data quality checks.

A `Check` holds an aggregate expression that counts violations, so any number of
checks runs in one pass over the table, or rides along on a write (see
`landfall.sinks.write_table`). Every check function returns rows of

    check_name, target, violations, rows_checked, passed

and never stops the job by itself; `enforce` turns failed rows into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import missing, named
from landfall.operators.aggregates import count_by
from landfall.operators.profiling import profile

_ROWS = "__rows_checked"


class QualityError(ValueError):
    """Raised by `enforce` when a check has failed."""


@dataclass(frozen=True)
class Check:
    """One check: its kind, what it looks at, and an aggregate counting violations."""

    name: str
    target: str
    violations: Column


def rules(predicates: Mapping[str, str]) -> list[Check]:
    """Row rules as SQL text; a rule that is false or unknown is violated."""
    return [
        Check("rule", name, F.count_if(~F.coalesce(F.expr(predicate), F.lit(False))))
        for name, predicate in predicates.items()
    ]


def no_nulls(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    """No NULL (or NaN) in the named columns."""
    return [Check("not_null", name, F.count_if(missing(df, name))) for name in columns]


def not_empty() -> Check:
    """At least one row."""
    return Check("not_empty", "*", (F.count(F.lit(1)) == 0).cast("bigint"))


def at_least_two(column: str) -> Check:
    """At least two different values: the smallest differs from the largest.

    No grouping and no shuffle of the values themselves, so it can ride along on a write.
    """
    differ = F.coalesce(F.min(named(column)) != F.max(named(column)), F.lit(False))
    return Check("min_distinct", column, (~differ).cast("bigint"))


def nan_as_null(df: DataFrame) -> DataFrame:
    """The frame all checks look at: NaN is a missing value.

    NaN sorts above every number in Spark, so `NaN > 1` would hold.
    """
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns(
        {name: F.when(~F.isnan(named(name)), named(name)) for name in floating}
    )


def _as_rows(one_row: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Turn one row of counters (v0, v1, ...) into one row per check."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(target).alias("target"),
            F.col(f"v{i}").cast("bigint").alias("violations"),
            F.col(_ROWS).alias("rows_checked"),
            (F.col(f"v{i}") == 0).alias("passed"),
        )
        for i, (name, target) in enumerate(labels)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in a single aggregation over the table."""
    counters = [check.violations.alias(f"v{i}") for i, check in enumerate(checks)]
    one_row = nan_as_null(df).agg(F.count(F.lit(1)).alias(_ROWS), *counters)
    return _as_rows(one_row, [(check.name, check.target) for check in checks])


def check_rules(df: DataFrame, predicates: Mapping[str, str]) -> DataFrame:
    """Violations of every row rule, counted in one pass."""
    return run_checks(df, rules(predicates))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per named column, counted in one pass."""
    return run_checks(df, no_nulls(df, columns))


def check_not_empty(df: DataFrame) -> DataFrame:
    """Fails on an empty frame. Reads at most one row per task, so `rows_checked` is 0 or 1."""
    return run_checks(df.limit(1), [not_empty()])


def check_min_distinct(df: DataFrame, columns: Sequence[str], at_least: int = 2) -> DataFrame:
    """At least `at_least` different values in each column; missing values do not count.

    One aggregation counts the distinct values of all columns, which Spark de-duplicates
    map-side before the shuffle.
    """
    return run_checks(
        df,
        [
            Check("min_distinct", name, (F.count_distinct(named(name)) < at_least).cast("bigint"))
            for name in columns
        ],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return count_by(df, *keys, out=out).where(named(out) > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violations are the keys that occur more than once."""
    one_row = count_by(df, *keys, out="n").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(_ROWS), F.count_if(F.col("n") > 1).alias("v0")
    )
    return _as_rows(one_row, [("unique", ", ".join(keys))])


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or surplus column: wanted type, found type, and the verdict.

    Compares metadata only; no data is read. `check_columns` adds what the rows say.
    """
    wanted = {field.name: field.dataType.simpleString() for field in expected}
    found = {field.name: field.dataType.simpleString() for field in df.schema}
    names = [*wanted, *(name for name in found if name not in wanted)]
    rows = [
        (name, wanted.get(name), found.get(name), wanted.get(name) == found.get(name))
        for name in names
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, data_type string, passed boolean"
    )


def check_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """`check_schema` with the number of rows and missing values of each found column."""
    found = profile(df).drop("position", "data_type").withColumnRenamed("column_name", "__found")
    joined = check_schema(df, expected).join(found, F.col("column_name") == F.col("__found"), "left")
    return joined.drop("__found")


def check_row_count(source: DataFrame, target: DataFrame, target_name: str = "*") -> DataFrame:
    """Source against target: violations are the rows missing or surplus in the target."""
    none, all_rows = F.lit(0).cast("bigint"), F.count(F.lit(1))
    counts = source.agg(all_rows.alias("s"), none.alias("t")).unionByName(
        target.agg(none.alias("s"), all_rows.alias("t"))
    )
    one_row = counts.agg(F.sum("s").alias(_ROWS), F.abs(F.sum("s") - F.sum("t")).alias("v0"))
    return _as_rows(one_row, [("row_count", target_name)])


def enforce(results: DataFrame) -> None:
    """Raise `QualityError` naming every failed check. Brings only failed rows to the driver."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        shown = "; ".join(f"{r.check_name} {r.target}: {r.violations}" for r in failed)
        raise QualityError(shown)


