"""Raw data readers. All return lazy DataFrames; no row passes through the driver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import named, null_tokens
from landfall.operators.shaping import align_to, union_extracts
from landfall.schemas import MONTHS


def read_extract(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """One extract in any data source format the session knows."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def monthly_paths(template: str, months: Sequence[str] = MONTHS) -> list[str]:
    """Twelve paths from a template such as 's3a://raw/i94_{month}16_sub.parquet'."""
    return [template.format(month=month) for month in months]


def read_extracts(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    contract: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """All extracts, one below the other, cut to the columns of the first one.

    Extra columns of later extracts are dropped; an extract that lacks a column is an
    error that names it.
    """
    frames = [read_extract(spark, path, fmt, schema, **options) for path in paths]
    return union_extracts(frames, contract)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    na_tokens: Iterable[str] = ("",),
    multi_line: bool = False,
) -> DataFrame:
    """A CSV table with a header line, typed by a fixed schema.

    Columns are matched by header name, whatever their order in the file. Values are
    read as text, cleared of `na_tokens`, then cast, so a malformed number raises
    under ANSI instead of turning into NULL. Files whose headers differ raise as well.
    `multi_line` is needed only where quoted values hold line breaks; such files
    cannot be split.
    """
    text = spark.read.csv(
        path,
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        enforceSchema=False,
        multiLine=multi_line,
        mode="FAILFAST",
    )
    tokens = tuple(na_tokens)
    aligned = align_to(text, schema.fieldNames())
    return aligned.select(
        [
            null_tokens(named(field.name), tokens).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )


def read_code_map(
    spark: SparkSession,
    path: str,
    pattern: str = "*.json",
    by_line: bool = False,
) -> DataFrame:
    """A JSON object {"key": "value", ...} as a table (key, value).

    By default a file holds one object, which may be spread over many lines, and is read as
    a whole by one task. With `by_line` every line holds an object of its own, and large
    files are split. Only files whose name fits `pattern` are read, which keeps notebooks
    and other strays in the folder out.
    """
    texts = spark.read.text(path, wholetext=not by_line, pathGlobFilter=pattern)
    files = texts.where(F.trim("value") != "") if by_line else texts
    entries = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return files.select(F.explode(entries).alias("key", "value"))
