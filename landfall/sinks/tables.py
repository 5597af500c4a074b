"""Partitioned Parquet tables with full or per-partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landfall.functions.columns import named
from landfall.operators.quality import Check, nan_as_null

_WRITTEN = "__written"
_MODES = {"full": "static", "partitions": "dynamic"}


@dataclass(frozen=True)
class WriteReport:
    """What a write saw on its way: rows written, and violations per check."""

    path: str
    rows: int
    checks: list[tuple[str, str, int]]


def _layout(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather the rows of each partition value, without one task per value.

    A plain `repartition(month)` would give twelve tasks however large the table. The
    rebalance hint lets AQE cut a large value into several tasks of the advisory size
    and merge small ones. Without AQE the hint could not split a hot value, so the rows
    stay where they are: more files, but no overfull task.
    """
    if str(df.sparkSession.conf.get("spark.sql.adaptive.enabled")).lower() != "true":
        return df
    return df.hint("rebalance", *partition_by)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "full",
    compact: bool = True,
    checks: Sequence[Check] = (),
    max_records_per_file: int | None = None,
) -> WriteReport:
    """Write a Parquet table to any Hadoop URI and report what was written.

    `mode="full"` replaces the table; `mode="partitions"` replaces only the partitions
    that occur in `df`. `compact` keeps the number of files small (see `_layout`); turn
    it off to save the shuffle. Row count and checks are taken in the write's own last
    stage, where Spark counts every finished task once, so they cost no second pass. They
    see the rows as `run_checks` does, with NaN as missing; what is written keeps its NaN.
    """
    if mode not in _MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {sorted(_MODES)}")
    if compact and partition_by:
        df = _layout(df, partition_by)
    seen = Observation()
    counters = [check.violations.alias(f"v{i}") for i, check in enumerate(checks)]
    rows = F.count(F.lit(1)).alias("rows")
    if counters:
        whole = df.withColumn(_WRITTEN, F.struct(*[named(name) for name in df.columns]))
        watched = nan_as_null(whole).observe(seen, rows, *counters).select(f"{_WRITTEN}.*")
    else:
        watched = df.observe(seen, rows)
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", _MODES[mode])
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    found = seen.get
    return WriteReport(
        path,
        found["rows"],
        [(check.name, check.target, int(found[f"v{i}"])) for i, check in enumerate(checks)],
    )


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write a CSV table with a header line, in the form `read_csv` reads back unchanged.

    Spark's writer trims blanks around values unless told otherwise.
    """
    df.write.mode("overwrite").csv(
        path,
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
