from __future__ import annotations

import random
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from landfall.operators import (
    check_rules,
    decode,
    distinct_rows,
    drop_missing,
    key_coverage,
    union_extracts,
)
from landfall.sinks import write_csv, write_table
from landfall.sources import read_csv

SCHEMA = "n int, d double, s string"
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TEXTS = st.text(alphabet='ab ,;"\\/=%é', min_size=1, max_size=6)
RECORDS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)),
        st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")])),
        st.one_of(st.none(), TEXTS),
    ),
    min_size=1,
    max_size=12,
)


@FEW
@given(RECORDS)
def test_distinct_twice_is_distinct_once(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    once = distinct_rows(df)
    assert rows(distinct_rows(once)) == rows(once)
    assert rows(distinct_rows(df.unionByName(df))) == rows(once)


@FEW
@given(RECORDS, st.randoms(use_true_random=False))
def test_union_does_not_see_column_order_or_extra_columns(spark, records, rng: random.Random):
    df = spark.createDataFrame(records, SCHEMA)
    names = [*df.columns, "1 AS delete_x"]
    rng.shuffle(names)
    assert rows(union_extracts([df, df.selectExpr(*names)])) == rows(df.unionByName(df))


@FEW
@given(RECORDS)
def test_violations_and_satisfied_rows_add_up(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    verdict = check_rules(df, {"r": "d > n"}).first()
    satisfied = drop_missing(df, ["n", "d"]).where("d > n").count()
    assert verdict.violations + satisfied == verdict.rows_checked == len(records)


@FEW
@given(RECORDS)
def test_table_round_trip(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    with tempfile.TemporaryDirectory() as folder:
        report = write_table(df, folder + "/t", ["n"])
        back = spark.read.schema("d double, s string, n int").parquet(folder + "/t")
        assert report.rows == len(records)
        assert rows(back.select("n", "d", "s")) == rows(df)


@FEW
@given(RECORDS, st.sampled_from([",", ";"]))
def test_csv_round_trip(spark, records, sep):
    df = spark.createDataFrame(records, SCHEMA)
    with tempfile.TemporaryDirectory() as folder:
        write_csv(df, folder + "/t", sep=sep)
        assert rows(read_csv(spark, folder + "/t", df.schema, sep=sep)) == rows(df)


@FEW
@given(RECORDS)
def test_decoding_by_a_unique_map_keeps_every_row(spark, records):
    df = spark.createDataFrame(records, SCHEMA)
    codes = spark.createDataFrame([("0", "zero"), ("1.5", "one and a half"), ("ALC", "x")], "key string, value string")
    decoded = decode(decode(df, "n", codes, "a"), "d", codes, "b")
    assert rows(decoded.select(*df.columns)) == rows(df)
    covered = key_coverage(df, codes, ("n", "key")).first()
    assert covered.facts == len(records)
    assert covered.matched == sum(record[0] == 0 for record in records)
