"""Build a lake from the command line:

    spark-submit --py-files landfall.zip landfall/__main__.py \\
        --arrivals 's3a://raw/i94_{month}16_sub.parquet' \\
        --temperature s3a://raw/temperature.csv --airports s3a://raw/airports.csv \\
        --demographics s3a://raw/demographics.csv --codes s3a://raw/desc \\
        --base s3a://lake

or `python -m landfall ...` with the same arguments.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from landfall.plans import LakeSources, build_lake
from landfall.schemas import LAKE_SCHEMAS, MONTHS
from landfall.sources import monthly_paths


CSV_TABLES = ("temperature", "airport_codes", "demographics")


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="landfall", description="Build the arrivals lake.")
    parser.add_argument(
        "--arrivals", required=True, nargs="+",
        help="one path with {month} in it, or the paths of all extracts, January first",
    )
    parser.add_argument("--arrivals-format", default="parquet")
    parser.add_argument("--months", nargs="+", default=list(MONTHS), choices=MONTHS)
    parser.add_argument("--temperature", required=True)
    parser.add_argument("--airports", required=True)
    parser.add_argument("--demographics", required=True)
    parser.add_argument(
        "--codes", required=True,
        help="folder with address_desc.json, airport_desc.json and visacode_desc.json",
    )
    parser.add_argument("--base", required=True, help="where the lake is written")
    parser.add_argument("--country", default="United States")
    parser.add_argument("--from-day", default="2000-01-01")
    parser.add_argument(
        "--na-tokens", nargs="+", default=[""], metavar="TEXT",
        help="texts in CSV files that stand for a missing value, the empty one included",
    )
    parser.add_argument(
        "--multi-line", nargs="+", default=[], choices=CSV_TABLES,
        help="tables whose CSV files hold line breaks inside quotes",
    )
    parser.add_argument("--code-maps-by-line", action="store_true")
    parser.add_argument("--by-year", action="store_true", help="partition by year, then month")
    parser.add_argument("--keep-arrival-date", action="store_true")
    parser.add_argument("--tables", nargs="+", choices=list(LAKE_SCHEMAS))
    parser.add_argument("--mode", choices=("full", "partitions"), default="full")
    parser.add_argument(
        "--versioned", action="store_true",
        help="publish each table as a new version in one step, and keep the old ones",
    )
    parser.add_argument("--strict", action="store_true", help="stop at the first failed check")
    return parser.parse_args(arguments)


def sources(options: argparse.Namespace) -> LakeSources:
    arrivals = options.arrivals
    if len(arrivals) == 1 and "{month}" in arrivals[0]:
        arrivals = monthly_paths(arrivals[0], options.months)
    codes = options.codes.rstrip("/")
    return LakeSources(
        arrivals=arrivals,
        temperature=options.temperature,
        airports=options.airports,
        demographics=options.demographics,
        address_codes=f"{codes}/address_desc.json",
        port_codes=f"{codes}/airport_desc.json",
        visa_codes=f"{codes}/visacode_desc.json",
        arrivals_format=options.arrivals_format,
        country=options.country,
        from_day=options.from_day,
        arrival_partitions=("year", "month") if options.by_year else ("month",),
        keep_arrival_date=options.keep_arrival_date,
        na_tokens=tuple(options.na_tokens),
        multi_line=tuple(options.multi_line),
        code_maps_by_line=options.code_maps_by_line,
    )


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    spark = SparkSession.builder.appName("landfall").getOrCreate()
    report = build_lake(
        spark, sources(options), options.base, options.tables, options.mode, options.strict,
        options.versioned,
    )
    report.show(report.count(), truncate=False)


if __name__ == "__main__":
    main()
