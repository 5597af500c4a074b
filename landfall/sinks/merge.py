"""Merging a load into a stored table, partition by partition."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import named
from landfall.operators.changes import DELETE, changed_keys, upserted
from landfall.sinks.snapshots import (
    Snapshot,
    current_snapshot,
    partition_texts,
    publish_table,
    read_snapshot,
)


@dataclass(frozen=True)
class MergeReport:
    """What a merge changed: keys by kind, and the partitions that were written or removed."""

    changes: dict[str, int]
    partitions: list[tuple]
    snapshot: Snapshot

    def count(self, kind: str) -> int:
        return self.changes.get(kind, 0)


def merge_table(
    load: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    delete_missing: bool = True,
) -> MergeReport:
    """Bring a versioned table up to date with a load, rewriting only partitions that change.

    A full load replaces the table's rows, and keys that it lacks go; with
    `delete_missing=False` it is a batch of inserts and updates. A load without a change
    commits nothing. Of the data the driver sees only which partitions changed, each with its
    number of changes.
    """
    spark = load.sparkSession
    before = current_snapshot(spark, path)
    if before is None:
        report, snapshot = publish_table(load, path, partition_by)
        return MergeReport({"insert": report.rows}, [], snapshot)
    if tuple(partition_by) != before.partition_by:
        raise ValueError(f"the table is partitioned by {before.partition_by}, not {tuple(partition_by)}")
    old = read_snapshot(spark, path, before.version)
    load = load.select(*[named(c) for c in old.columns])
    moved = changed_keys(old, load, keys, carried=partition_by)
    if not delete_missing:
        moved = moved.where(F.col("change") != DELETE)
    # An update that moves a row to another partition touches both.
    ends = [
        F.struct(*[F.col(f"{side}_{c}").alias(c) for c in partition_by], F.lit(side).alias("__side"))
        for side in ("old", "new")
    ]
    both = F.array(*ends) if partition_by else F.array(F.struct(F.lit("new").alias("__side")))
    there = (F.col("change") != "insert") & (F.col("__end")["__side"] == "old")
    there |= (F.col("change") != DELETE) & (F.col("__end")["__side"] == "new")
    texts = [F.col("__end")[c].cast("string").alias(f"__text_{i}") for i, c in enumerate(partition_by)]
    touched = (
        moved.withColumn("__end", F.explode(both))
        .where(there if partition_by else F.lit(True))
        .select(*[F.col("__end")[c].alias(c) for c in partition_by], *texts)
        .distinct()
    )
    changes = {row["change"]: row["count"] for row in moved.groupBy("change").count().collect()}
    if not changes:
        return MergeReport({}, [], before)
    found = [tuple(row) for row in touched.collect()]
    width = len(partition_by)
    partitions = [row[:width] for row in found]
    rows = load if delete_missing else upserted(old, load, keys)
    if partition_by:
        rows = _within(rows, partition_by, partitions)
    by_text = {partition_texts(folder): folder for parts in before.folders.values() for folder in parts}
    removed = [by_text[row[width:]] for row in found if row[width:] in by_text]
    _, snapshot = publish_table(rows, path, partition_by, "partitions", removed=removed, on=before)
    return MergeReport(changes, partitions, snapshot)


def _within(df: DataFrame, partition_by: Sequence[str], partitions: list[tuple]) -> DataFrame:
    """Rows of some partitions; the test names their values, so that other folders are not read."""
    if len(partition_by) == 1:
        column, values = named(partition_by[0]), [value for (value,) in partitions]
        test = column.isin([value for value in values if value is not None])
        return df.where(test | column.isNull() if None in values else test)
    test = F.lit(False)
    for values in partitions:
        one = F.lit(True)
        for name, value in zip(partition_by, values, strict=True):
            one &= named(name).eqNullSafe(F.lit(value))
        test |= one
    return df.where(test)
