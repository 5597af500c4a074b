"""Extracts that arrive one after the other, taken as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.schemas import LAKE_SCHEMAS
from landfall.streaming import arrival_windows, conform_arrivals_stream, run_available, stream_extracts
from landfall.workloads import frames
from landfall.workloads.flows import CONFORMED_ARRIVALS
from landfall.workloads.registry import query, scratch

#: Days by which rows may be late; extracts repeat rows of the year before.
_LATE = 400


def _as_extracts_come(
    spark: SparkSession, sf_dir: str, label: str, plan: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> str:
    """Put one extract a year into a folder, in order of time, and run the stream after each.

    Each extract holds the December of the year before again. Returns the stream's table.
    """
    folder, table, checkpoint = (scratch(spark, f"{label}_{part}") for part in ("raw", "table", "state"))
    raw = frames.raw_arrivals(spark, sf_dir)
    for year in sorted(row[0] for row in raw.select("i94yr").distinct().collect()):
        again = (F.col("i94yr") == year - 1) & (F.col("i94mon") == 12)
        raw.where((F.col("i94yr") == year) | again).write.mode("append").parquet(folder)
        extracts = stream_extracts(spark, folder, raw.schema)
        run_available(plan(extracts), table, checkpoint, partition_by)
    return table


@query(CONFORMED_ARRIVALS)
def streamed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after a run for each year's extract: the same rows as in one go."""
    table = _as_extracts_come(
        spark, sf_dir, "streamed_facts", lambda raw: conform_arrivals_stream(raw, f"{_LATE} days"), ["month"]
    )
    return spark.read.schema(LAKE_SCHEMAS["immigration"]).parquet(table)


@query(f"""
with {frames.RAW_ARRIVALS},
once as (
  select distinct *, (date '1960-01-01' + arrdate::int)::date as day from raw_arrivals
  where i94mode = 1 and i94yr is not null and i94mon is not null
    and i94port is not null and arrdate is not null and i94bir is not null),
counted as (
  select (date '1970-01-01' + (floor((day - date '1970-01-01') / 7) * 7)::int)::date as window_start,
         i94port, count(*) as arrivals
  from once group by 1, 2)
select window_start, (window_start + 7)::date as window_end, i94port, arrivals from counted
where window_start + 7 <= (select max(day) from once) - {_LATE}""")
def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per week and port, given out once no late row can change a week."""
    table = _as_extracts_come(
        spark, sf_dir, "streamed_windows", lambda raw: arrival_windows(raw, f"{_LATE} days")
    )
    return spark.read.parquet(table)
