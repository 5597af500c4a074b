from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from landfall.operators import (
    QualityError,
    StepCounter,
    at_least_two,
    check_columns,
    check_min_distinct,
    check_not_empty,
    check_not_null,
    check_row_count,
    check_rules,
    check_schema,
    check_unique,
    duplicate_keys,
    enforce,
    no_nulls,
    not_empty,
    null_profile,
    profile,
    rules,
    run_checks,
    step_counts,
)

NAN = float("nan")
from landfall.sinks import write_table


@pytest.fixture
def people(spark):
    data = [(10, 4.0, "a"), (3, 5.0, "b"), (7, None, "b"), (8, NAN, None)]
    return spark.createDataFrame(data, "total int, part double, name string")


def test_rules_count_false_unknown_and_nan(people):
    found = check_rules(people, {"covers": "total > part", "positive": "total > 0", "nan": "part > 1"})
    assert {r.target: (r.violations, r.passed) for r in found.collect()} == {
        "covers": (3, False),
        "positive": (0, True),
        "nan": (2, False),
    }
    assert {r.rows_checked for r in found.collect()} == {4}


def test_all_rules_share_one_scan(people):
    plan = plan_of(check_rules(people, {"a": "total > 1", "b": "total > 2", "c": "part > 1"}))
    assert plan.count("Scan") == 1


def test_emptiness_is_really_checked(spark, people):
    assert check_not_empty(people).first().passed
    assert not check_not_empty(people.where("total > 99")).first().passed
    assert not check_not_empty(people.limit(0)).first().passed


@pytest.mark.parametrize("at_least", [2, 3])
def test_distinct_values_are_really_checked(people, at_least):
    same = people.withColumn("name", F.lit("a"))
    assert not check_min_distinct(same, ["name"], at_least).first().passed
    assert not check_min_distinct(people.limit(0), ["name"], at_least).first().passed
    assert check_min_distinct(people, ["total"], at_least).first().passed
    assert check_min_distinct(people, ["name"], at_least).first().passed is (at_least == 2)


def test_nan_is_no_value_in_any_check(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    one = df.where("x = 1 OR isnan(x)")
    assert not check_min_distinct(df, ["x"], 3).first().passed
    assert not check_min_distinct(one, ["x"]).first().passed
    checks = [at_least_two("x"), *no_nulls(one, ["x"]), *rules({"positive": "x > 0", "open": "x IS NULL OR x > 0"})]
    loose = write_table(one, str(tmp_path / "t"), checks=checks).checks
    strict = [(r.check_name, r.target, r.violations) for r in run_checks(one, checks).collect()]
    assert loose == strict == [("min_distinct", "x", 1), ("not_null", "x", 1), ("rule", "positive", 1), ("rule", "open", 0)]
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(one)


def test_distinct_counts_of_all_columns_share_one_scan(people):
    plan = plan_of(check_min_distinct(people, ["name", "total", "part"], 3))
    assert plan.count("Scan") == 1


def test_columns_with_their_rows(people):
    found = {r.column_name: r for r in check_columns(people, people.schema).collect()}
    assert (found["part"].passed, found["part"].row_count, found["part"].null_count) == (True, 4, 2)


def test_not_null_counts_nan(people):
    found = {r.target: r.violations for r in check_not_null(people, ["part", "name", "total"]).collect()}
    assert found == {"part": 2, "name": 1, "total": 0}


def test_unique(people):
    assert rows(duplicate_keys(people, ["name"])) == [("b", 2)]
    assert check_unique(people, ["name"]).first().violations == 1
    assert check_unique(people, ["name", "total"]).first().passed
    assert check_unique(people.limit(0), ["name"]).first().rows_checked == 0


def test_schema(people):
    from pyspark.sql.types import StringType, StructField, StructType

    verdict = check_schema(people, StructType([StructField("total", StringType())])).collect()
    assert [(r.column_name, r.expected_type, r.data_type, r.passed) for r in verdict] == [
        ("total", "string", "int", False),
        ("part", None, "double", False),
        ("name", None, "string", False),
    ]
    assert all(r.passed for r in check_schema(people, people.schema).collect())


def test_row_count(people):
    assert check_row_count(people, people).first().passed
    assert check_row_count(people, people.limit(1)).first().violations == 3
    assert check_row_count(people.limit(1), people).first().violations == 3


def test_enforce_names_the_failures(people):
    checks = [not_empty(), at_least_two("name"), *no_nulls(people, ["name"]), *rules({"big": "total > 5"})]
    results = run_checks(people, checks)
    with pytest.raises(QualityError, match="not_null name: 1; rule big: 1"):
        enforce(results)
    enforce(results.where("passed"))


def test_profiles(people):
    assert rows(null_profile(people)) == [("name", 1), ("part", 2), ("total", 0)]
    assert rows(profile(people)) == [
        (0, "total", "int", 4, 4, 0),
        (1, "part", "double", 4, 2, 2),
        (2, "name", "string", 4, 3, 1),
    ]


def test_step_counts_build_on_each_other(people):
    steps = {"large": F.col("total") > 5, "b": F.col("name") == "b"}
    assert rows(step_counts(people, steps)) == [("b", 1), ("large", 3), ("read", 4)]


def test_step_counter_runs_no_job_of_its_own(people):
    counter = StepCounter()
    marked = counter.mark("kept", counter.mark("read", people).where("total > 5"))
    marked.write.format("noop").mode("overwrite").save()
    assert counter.counts() == {"read": 4, "kept": 3}
