from __future__ import annotations

from pyspark.sql import functions as F

from conftest import plan_of, rows
from landfall.operators import distinct_rows


def test_both_zeros_and_all_nans_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (-float("nan"),)], "d double")
    assert distinct_rows(df).count() == 2


def test_missing_and_empty_are_different(spark):
    df = spark.createDataFrame([(None, ""), (None, ""), ("", None), ("a", "")], "a string, b string")
    assert distinct_rows(df).count() == 3


def test_texts_are_compared_by_their_collation(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",), ("b",)], "s string")
    folded = df.select(F.collate("s", "UTF8_LCASE").alias("s"))
    assert distinct_rows(folded).count() == 2
    assert rows(distinct_rows(df)) == [("A",), ("a",), ("b",)]


def test_a_third_of_all_rows_is_one_row(spark):
    third = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"),
    )
    found = distinct_rows(third)
    assert found.count() == 20001
    assert found.where("b = 'hot'").count() == 1
    # Hot copies meet in their own map task before anything moves.
    plan = plan_of(found)
    assert "HashAggregate" in plan[plan.index("Exchange hashpartitioning") :]
