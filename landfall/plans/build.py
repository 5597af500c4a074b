"""The whole run: read the raw data, write all seven tables, report on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.quality import (
    Check,
    QualityError,
    check_unique,
    enforce,
    run_checks,
)
from landfall.plans.conform import (
    airport_checks,
    arrival_checks,
    code_map_checks,
    conform_airports,
    conform_arrivals,
    conform_demographics,
    conform_temperature,
    demographics_checks,
    temperature_checks,
)
from landfall.schemas import (
    AIRPORT_CSV,
    DEMOGRAPHICS_CSV,
    LAKE_KEYS,
    LAKE_PARTITIONS,
    TEMPERATURE_CSV,
)
from landfall.sinks.snapshots import publish_table, read_snapshot
from landfall.sinks.tables import write_table
from landfall.sources.lake import open_lake, table_path
from landfall.sources.readers import read_code_map, read_csv, read_extracts

# A lazy table and the checks to count while it is written.
Flow = tuple[DataFrame, list[Check]]

_REPORT = (
    "table_name string, check_name string, target string, violations bigint, "
    "rows_checked bigint, passed boolean"
)


@dataclass(frozen=True)
class LakeSources:
    """Where the raw data lies, as Hadoop URIs, and how to take it.

    Extracts of several years go with `arrival_partitions=("year", "month")`. Questions at
    day grain need `keep_arrival_date`. The three CSV tables share `na_tokens`, texts that
    stand for a missing value; `multi_line` names those whose quoted values may hold line
    breaks. `code_maps_by_line` reads code maps of one JSON object per line, which can be
    split, instead of one object per file.
    """

    arrivals: Sequence[str]
    temperature: str
    airports: str
    demographics: str
    address_codes: str
    port_codes: str
    visa_codes: str
    arrivals_format: str = "parquet"
    country: str = "United States"
    from_day: str = "2000-01-01"
    code_map_pattern: str = "*.json"
    arrival_partitions: Sequence[str] = LAKE_PARTITIONS["immigration"]
    keep_arrival_date: bool = False
    na_tokens: Sequence[str] = ("",)
    multi_line: Sequence[str] = ()
    code_maps_by_line: bool = False

    def csv_options(self, table: str) -> dict[str, object]:
        return {"na_tokens": self.na_tokens, "multi_line": table in self.multi_line}


def _temperature(spark: SparkSession, sources: LakeSources) -> Flow:
    raw = read_csv(spark, sources.temperature, TEMPERATURE_CSV, **sources.csv_options("temperature"))
    return conform_temperature(raw, sources.country, sources.from_day), temperature_checks()


def _airports(spark: SparkSession, sources: LakeSources) -> Flow:
    raw = read_csv(spark, sources.airports, AIRPORT_CSV, **sources.csv_options("airport_codes"))
    airports = conform_airports(raw)
    return airports, airport_checks(airports)


def _demographics(spark: SparkSession, sources: LakeSources) -> Flow:
    options = sources.csv_options("demographics")
    raw = read_csv(spark, sources.demographics, DEMOGRAPHICS_CSV, sep=";", **options)
    return conform_demographics(raw), demographics_checks()


def _arrivals(spark: SparkSession, sources: LakeSources) -> Flow:
    extracts = read_extracts(spark, list(sources.arrivals), sources.arrivals_format)
    arrivals = conform_arrivals(extracts, sources.keep_arrival_date)
    return arrivals, arrival_checks(arrivals)


def _code_map(path_of: str) -> Callable[[SparkSession, LakeSources], Flow]:
    def flow(spark: SparkSession, sources: LakeSources) -> Flow:
        codes = read_code_map(
            spark, getattr(sources, path_of), sources.code_map_pattern, sources.code_maps_by_line
        )
        return codes, code_map_checks(codes)

    return flow


_FLOWS: dict[str, Callable[[SparkSession, LakeSources], Flow]] = {
    "temperature": _temperature,
    "airport_codes": _airports,
    "demographics": _demographics,
    "immigration": _arrivals,
    "address_desc": _code_map("address_codes"),
    "airport_desc": _code_map("port_codes"),
    "visacode_desc": _code_map("visa_codes"),
}


def build_lake(
    spark: SparkSession,
    sources: LakeSources,
    base: str,
    tables: Sequence[str] | None = None,
    mode: str = "full",
    strict: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """Write the lake below `base` and return one report row per table and check.

    Checks are counted while a table is written and only reported, so each raw table is
    read once. With `strict` they run before the write instead, and a failure raises
    while the old table still stands; that costs a second read.
    The tables do not depend on each other and are written side by side, so that small ones
    fill the gaps of large ones; a failure is raised once all have ended.
    `tables` limits the run, for sources that are refreshed at different times; an empty
    list writes nothing. `mode="partitions"` replaces only the partitions that occur in the
    new data. The fact table then has to be partitioned by year as well: with months alone,
    a month of one year would replace that month of all years. With `versioned` each table is
    published as a new version in one step, so a failed write leaves the old one (see
    `landfall.sinks.snapshots`); a table is versioned from its first write on or never.
    """
    wanted = list(_FLOWS) if tables is None else list(tables)
    if mode == "partitions" and "immigration" in wanted and "year" not in sources.arrival_partitions:
        raise ValueError("mode='partitions' needs 'year' among arrival_partitions")

    def write(table: str) -> list[tuple]:
        df, checks = _FLOWS[table](spark, sources)
        if strict:
            try:
                enforce(run_checks(df, checks))
            except QualityError as failed:
                raise QualityError(f"{table}: {failed}") from failed
        path = table_path(base, table)
        partition_by = LAKE_PARTITIONS.get(table, ())
        if table == "immigration":
            partition_by = tuple(sources.arrival_partitions)
        added = None
        if versioned:
            written, snapshot = publish_table(df, path, partition_by, mode, checks=checks)
            added = read_snapshot(spark, path, snapshot.version, only_written=True)
        else:
            written = write_table(df, path, partition_by, mode, checks=checks)
        found = [
            (table, name, target, violations, written.rows, violations == 0)
            for name, target, violations in written.checks
        ]
        refreshed = None
        if mode == "partitions" and partition_by and not versioned:
            refreshed = df.select(*partition_by)
        return found + _stored_checks(spark, base, table, written.rows, refreshed, added)

    with ThreadPoolExecutor(max_workers=max(1, len(wanted))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write), table) for table in wanted]
        report = [row for flow in running for row in flow.result()]
    return spark.createDataFrame(report, _REPORT)


def _stored_checks(
    spark: SparkSession,
    base: str,
    table: str,
    rows_written: int,
    refreshed: DataFrame | None = None,
    added: DataFrame | None = None,
) -> list[tuple]:
    """What only the finished table can tell: its row count, which Parquet answers from
    its footers, and whether the keys of a dimension are unique.

    After a refresh only the partitions in `refreshed` are counted, which reads the
    partition columns of the new data once more. A versioned table knows what it has `added`.
    """
    stored = open_lake(spark, base, [table], register=False)[table]
    written = stored if added is None else added
    if refreshed is not None:
        keys = refreshed.distinct().withColumnsRenamed({c: f"new_{c}" for c in refreshed.columns})
        same = [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in refreshed.columns]
        written = stored.join(keys, same, "left_semi")
    lost = abs(rows_written - written.count())
    found = [(table, "row_count", "*", lost, rows_written, lost == 0)]
    if table in LAKE_KEYS:
        found.append((table, *check_unique(stored, LAKE_KEYS[table]).first()))
    return found
