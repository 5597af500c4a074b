"""The pipeline's stages, each on all that the one before it kept."""

from __future__ import annotations

import collections

import corpus_pipeline
import pytest

import __spark_entry__ as contract

from conftest import SMALL
from tools.check_oracle import compare, open_tables
from test_llm_units import brute_join, brute_targets, check_packing, empty, odd, texts_of, WORD

COLUMNS = list(corpus_pipeline.COLUMNS)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SMALL).checkpoint())
    assert all(df.columns == COLUMNS for df in kept[:-1])
    start, clean, single, private, mixed, packed = kept
    left = {d for d, _ in texts_of(clean)}
    assert left < {d for d, _ in texts_of(start)}
    plain = [d for d, toxic in labels.items() if not toxic]
    assert sum(d in left for d in plain) > 0.9 * len(plain)
    groups = brute_join(texts_of(clean))
    assert sorted(d for d, _ in texts_of(single)) == sorted(d for d, (chief, _, _) in groups.items() if d == chief)
    assert sorted(d for d, _ in texts_of(private)) == sorted(d for d, _ in texts_of(single))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in private.collect():
        sizes[r.source] += len(WORD.findall(r.text))
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text))
    targets = brute_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= 100 for s in sizes)
    check_packing(texts_of(mixed), packed.collect())


@pytest.mark.parametrize("make", [odd, empty])
def test_odd_and_empty_tables_pass(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).checkpoint()
    assert docs.count() == (docs.select("sequence_id", "offset").distinct().count())


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns[:4] == ["doc_id", "start", "length", "ids_crc32"] and rows.count() > 0


@pytest.mark.parametrize("name", ["op3_mixing", "op6_quality_rules", "op8_chat_formatting"])
def test_queries_agree_with_their_sql(spark, name):
    sql, query = contract.oracle_sql()[name], contract.queries()[name]
    assert compare(open_tables(SMALL), sql, query(spark, SMALL)) is None


def test_every_operator_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 11))
