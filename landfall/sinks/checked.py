"""Tables whose check results are kept per partition and combined.

Beside a versioned table lie two small ones, partitioned alike: counters per partition and
check, and a fingerprint per key. A refresh of some partitions counts only the rows it has
written and replaces only their state; the result for the whole table is a sum over states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.columns import named
from landfall.operators.quality import Check, nan_as_null
from landfall.sinks.snapshots import Snapshot, current_snapshot, publish_table, read_snapshot

_COUNTS, _KEYS = "check_counts", "check_keys"


def partition_state(df: DataFrame, partition_by: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """One row per partition and check: violations, rows, and for checks of distinct values the
    least and greatest as text. One aggregation."""
    counters = [check.violations.cast("bigint").alias(f"v{i}") for i, check in enumerate(checks)]
    ends = []
    for i, check in enumerate(checks):
        of_values = check.name == "min_distinct"
        for name, pick in (("low", F.min), ("high", F.max)):
            value = pick(named(check.target)).cast("string") if of_values else F.lit(None).cast("string")
            ends.append(value.alias(f"{name}{i}"))
    keys = [named(c) for c in partition_by]
    rows = F.count(F.lit(1)).alias("rows_checked")
    counted = nan_as_null(df).groupBy(*keys).agg(rows, *counters, *ends)
    entries = [
        F.struct(
            F.lit(check.name).alias("check_name"), F.lit(check.target).alias("target"),
            F.col(f"v{i}").alias("violations"), F.col(f"low{i}").alias("low"), F.col(f"high{i}").alias("high"),
        )
        for i, check in enumerate(checks)
    ]
    return counted.select(*keys, "rows_checked", F.inline(F.array(*entries)))


def combined_state(states: DataFrame) -> DataFrame:
    """The results for the whole table, in the form of `run_checks`."""
    one_value = F.coalesce(F.min("low") == F.max("high"), F.lit(True))
    violations = (
        F.when(F.col("check_name") == "not_empty", (F.sum("rows_checked") == 0).cast("bigint"))
        .when(F.col("check_name") == "min_distinct", one_value.cast("bigint"))
        .otherwise(F.sum("violations"))
    )
    found = states.groupBy("check_name", "target").agg(
        violations.alias("violations"), F.sum("rows_checked").alias("rows_checked")
    )
    return found.withColumn("passed", F.col("violations") == 0)


def key_state(df: DataFrame, partition_by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per partition and key, the key as 128 bits, with its number of rows."""
    values = [part for name in keys for part in (named(name).isNull(), named(name))]
    prints = [F.xxhash64(F.lit(n), *values).alias(f"key_{n}") for n in (1, 2)]
    return df.groupBy(*[named(c) for c in partition_by], *prints).agg(F.count(F.lit(1)).alias("n"))


def combined_keys(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The result of `check_unique` for the whole table, from its key states."""
    per_key = states.groupBy("key_1", "key_2").agg(F.sum("n").alias("n"))
    counted = per_key.agg(
        F.count_if(F.col("n") > 1).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
    )
    return counted.select(
        F.lit("unique").alias("check_name"), F.lit(", ".join(keys)).alias("target"),
        "violations", "rows_checked", (F.col("violations") == 0).alias("passed"),
    )


def publish_checked(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "full",
    checks: Sequence[Check] = (),
    unique: Sequence[str] = (),
) -> Snapshot:
    """Publish a version of a table and the state of its checks.

    The checks are counted on the rows as they were written, so `df` is evaluated once and of
    the stored table only what this version added is read. `unique` names key columns.
    """
    _, snapshot = publish_table(df, path, partition_by, mode)
    spark = df.sparkSession
    added = read_snapshot(spark, path, snapshot.version, only_written=True)
    notes = {"table_version": snapshot.version, "unique": list(unique)}
    if checks:
        state = partition_state(added, partition_by, checks)
        publish_table(state, f"{path}/{_COUNTS}", partition_by, mode, notes=notes)
    if unique:
        state = key_state(added, partition_by, unique)
        publish_table(state, f"{path}/{_KEYS}", partition_by, mode, notes=notes)
    return snapshot


def stored_checks(spark: SparkSession, path: str) -> DataFrame:
    """The check results of a table's newest version, from its states alone.

    A state that is not of that version, because a run died between the two, is an error.
    """
    table = current_snapshot(spark, path)
    found = []
    for name in (_COUNTS, _KEYS):
        state = current_snapshot(spark, f"{path}/{name}")
        if state is None:
            continue
        if table is None or state.notes["table_version"] != table.version:
            raise ValueError(f"the checks of {path} are not those of its newest version")
        rows = read_snapshot(spark, f"{path}/{name}", state.version)
        found.append(combined_state(rows) if name == _COUNTS else combined_keys(rows, state.notes["unique"]))
    if not found:
        raise ValueError(f"{path} has no stored checks")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
