"""The corpus pipeline: filter, de-duplicate, clean, mix and pack documents.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns
the columns of `documents`, but for the last, which returns the pieces of the packed
sequences. `run` writes each stage's result to the shared folder and reads it again; what a stage has
read is freed once its own result is written.

NULL texts, empty tables and extra columns are handled as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import discard, stored
from landfall.llm.mixing import mix, mixed_documents
from landfall.llm.ngram_join import one_per_class
from landfall.llm.packing import pack
from landfall.llm.pii import replace_pii
from landfall.llm.registry import query
from landfall.llm.toxicity import train, without_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    docs = docs.select(*COLUMNS)
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal and nearly equal texts."""
    return one_per_class(docs.select(*COLUMNS))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data."""
    return replace_pii(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row for each copy, and the leading words of a cut document.

    A document without a word has nothing to take and is not in the mix.
    """
    return mixed_documents(mix(docs)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 2048 tokens."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "segment", "loss_tokens",
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: Training a classifier and tokenizing are beyond SQL; tests compare each stage with plain
#: Python on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
