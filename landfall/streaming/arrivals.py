"""The arrivals dataflow on a folder into which extracts are put one after the other.

Each run takes the files that are new, in micro-batches, and stops. What it remembers between
runs lies in its checkpoint folder: the files it has seen, and the rows of the last days,
against which copies in later extracts are recognised. `lateness` bounds that memory: rows
older than the newest arrival by more are late and left out, and older rows are forgotten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landfall.functions.columns import day_number_to_date, named, type_of
from landfall.operators.distinct import distinct_rows
from landfall.operators.shaping import align_to, drop_missing
from landfall.plans.conform import conform_arrivals
from landfall.schemas import ARRIVAL_REQUIRED, ARRIVED_BY_AIR

#: The column that says when a raw row happened.
EVENT_TIME = "arrived_at"


def stream_extracts(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    contract: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """The extracts in a folder as a stream, older files first, cut to the contract's columns.

    `schema` fixes the types; a file that lacks a column gives NULL there. `files_per_batch`
    bounds a micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return align_to(reader.load(folder), contract or schema.fieldNames())


def _arrival_time(df: DataFrame) -> Column:
    if isinstance(type_of(df, "arrdate"), T.NumericType):
        return day_number_to_date(named("arrdate")).cast("timestamp")
    return named("arrdate").cast("timestamp")


def with_event_time(extracts: DataFrame, lateness: str) -> DataFrame:
    """Complete rows of people who came by plane, with `EVENT_TIME` and a watermark on it."""
    kept = drop_missing(extracts.where(F.col("i94mode") == ARRIVED_BY_AIR), ARRIVAL_REQUIRED)
    return kept.withColumn(EVENT_TIME, _arrival_time(kept)).withWatermark(EVENT_TIME, lateness)


def conform_arrivals_stream(
    extracts: DataFrame, lateness: str, keep_arrival_date: bool = False
) -> DataFrame:
    """The fact table as a stream: the rows of `conform_arrivals`, each once.

    Copies are compared over all raw columns, in and across extracts. The time of a row is
    one of these columns, so rows behind the watermark need not be remembered.
    """
    return conform_arrivals(with_event_time(extracts, lateness), keep_arrival_date)


def arrival_windows(
    extracts: DataFrame, lateness: str, window: str = "7 days", keys: Sequence[str] = ("i94port",)
) -> DataFrame:
    """Arrivals per window of time and key, copies counted once.

    A window is given out once, when the watermark has passed its end, so that no later row
    can change it. `window_start` and `window_end` are dates.
    """
    once = distinct_rows(with_event_time(extracts, lateness))
    counted = once.groupBy(F.window(EVENT_TIME, window), *[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return counted.select(
        F.col("window.start").cast("date").alias("window_start"),
        F.col("window.end").cast("date").alias("window_end"),
        *[named(k) for k in keys],
        "arrivals",
    )


def run_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append what new files bring to a Parquet table, and return when all are taken.

    The sink writes each micro-batch once: a run that dies is taken up again where its
    checkpoint says, and rows of an unfinished batch are not seen by readers of the table.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query
