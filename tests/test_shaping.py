from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from landfall.functions import code_key, day_number, day_number_to_date, period_columns
from landfall.operators import (
    align_to,
    cast_columns,
    distinct_rows,
    drop_missing,
    rename,
    since,
    union_extracts,
    with_duration,
)


def test_align_cuts_and_orders_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, extra int, a int")
    assert align_to(df, ["a", "b"]).columns == ["a", "b"]
    assert rows(align_to(df, ["a", "b"])) == [(3, 1)]


def test_align_follows_sparks_case_rule_and_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, 2)], "I94YR int, b int")
    assert align_to(df, ["i94yr"]).columns == ["i94yr"]
    with pytest.raises(ValueError, match="i94mon, i94port"):
        align_to(df, ["i94yr", "i94mon", "i94port"])


def test_union_matches_by_name_and_keeps_copies(spark):
    first = spark.createDataFrame([(1, "x")], "n int, t string")
    second = spark.createDataFrame([("y", 0.0, 2), ("x", 0.0, 1)], "t string, delete_a double, n int")
    united = union_extracts([first, second])
    assert united.columns == ["n", "t"]
    assert rows(united) == [(1, "x"), (1, "x"), (2, "y")]


def test_union_of_nothing_is_an_error():
    with pytest.raises(ValueError, match="no extracts"):
        union_extracts([])


def test_distinct_folds_null_with_null_and_nan_with_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, None), (1, None), (2, nan), (2, nan), (3, 0.5)], "k int, v double")
    assert distinct_rows(df).count() == 3


def test_drop_missing_equals_dropna(spark):
    nan = float("nan")
    data = [(1.0, "a", 1), (nan, "b", 2), (None, "c", 3), (2.0, None, 4), (3.0, "NaN", None)]
    df = spark.createDataFrame(data, "d double, s string, n int")
    assert rows(drop_missing(df)) == rows(df.dropna())
    assert rows(drop_missing(df, ["d"])) == rows(df.dropna(subset=["d"]))
    assert rows(drop_missing(df, ["n", "s"])) == rows(df.dropna(subset=["n", "s"]))


def test_drop_missing_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, "a")], "d double, s string").write.parquet(path)
    plan = plan_of(drop_missing(spark.read.parquet(path)))
    assert "IsNotNull(d)" in plan and "IsNotNull(s)" in plan


def test_names_with_dots_spaces_and_hyphens(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "`a.b` double, `Foreign-born x` double")
    assert rows(drop_missing(df)) == [(2.0, 3.0)]
    assert align_to(df, ["Foreign-born x", "a.b"]).columns == ["Foreign-born x", "a.b"]
    assert rename(df, {"a.b": "c"}).columns == ["c", "Foreign-born x"]


def test_rename_ignores_unknown_names_unless_strict(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rename(df, {"a": "b", "zz": "y"}).columns == ["b"]
    with pytest.raises(ValueError, match="zz"):
        rename(df, {"zz": "y"}, strict=True)


def test_cast_truncates_and_refuses_nan(spark):
    df = spark.createDataFrame([(2.9,)], "v double")
    assert rows(cast_columns(df, {"v": "bigint"})) == [(2,)]
    bad = spark.createDataFrame([(float("nan"),)], "v double")
    with pytest.raises(Exception, match="CAST_OVERFLOW|cannot be cast"):
        cast_columns(bad, {"v": "bigint"}).collect()


def test_duration_of_day_numbers(spark):
    df = spark.createDataFrame(
        [(10.0, 15.0), (10.0, None), (None, 1.0), (10.0, 4.0)], "a double, b double"
    )
    out = [row.days for row in with_duration(df, "a", "b", "days").collect()]
    assert out == [5.0, None, None, -6.0]
    assert dict(with_duration(df, "a", "b", "days").dtypes)["days"] == "double"


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_duration_of_dates_is_a_double(spark, kind):
    df = spark.sql(f"SELECT CAST('2016-01-30' AS {kind}) a, CAST('2016-02-02' AS {kind}) b")
    timed = with_duration(df, "a", "b", "days")
    assert dict(timed.dtypes)["days"] == "double"
    assert timed.first().days == 3.0


def test_duration_refuses_mixed_types(spark):
    df = spark.sql("SELECT 1.0D a, DATE'2016-01-01' b")
    with pytest.raises(TypeError, match="must both be"):
        with_duration(df, "a", "b", "days")


def test_since_is_inclusive_for_every_type(spark):
    days = ["1999-12-31", "2000-01-01", "2013-05-01"]
    text = spark.createDataFrame([(day,) for day in days], "dt string")
    for kind in ("string", "date", "timestamp", "timestamp_ntz"):
        df = text.select(F.col("dt").cast(kind))
        assert since(df, "dt", "2000-01-01").count() == 2
    assert since(text, "dt", dt.date(2000, 1, 1)).count() == 2
    assert rows(since(text, "dt", "2000-01-01")) == rows(text.where("dt >= '2000-01-01'"))


def test_since_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01 10:00:00' ts").write.parquet(path)
    assert "GreaterThanOrEqual(ts" in plan_of(since(spark.read.parquet(path), "ts", "2000-01-01"))


def test_since_on_text_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    days = ["1999-12-31", "2000-01-01", "2000-01-01 10:00:00", "2000-12-09", "2010-01-01", None]
    spark.createDataFrame([(d,) for d in days], "dt string").write.parquet(path)
    found = since(spark.read.parquet(path), "dt", "2000-01-01")
    assert "GreaterThanOrEqual(dt,2000-01-01)" in plan_of(found)
    assert sorted(r.dt for r in found.collect()) == days[1:5]


def test_day_numbers_start_in_1960(spark):
    df = spark.sql("SELECT 20454.0D n UNION ALL SELECT 0.0D UNION ALL SELECT CAST(NULL AS DOUBLE)")
    back = df.select("n", day_number_to_date(F.col("n")).alias("d"))
    assert {row.n: row.d for row in back.collect()} == {
        20454.0: dt.date(2016, 1, 1),
        0.0: dt.date(1960, 1, 1),
        None: None,
    }
    round_trip = back.where("n IS NOT NULL").select(day_number(F.col("d")) == F.col("n"))
    assert rows(round_trip) == [(True,), (True,)]


def test_code_keys(spark):
    df = spark.sql("SELECT 1.0D v UNION ALL SELECT 1.5D UNION ALL SELECT DOUBLE('NaN')")
    keys = {row[0] for row in df.select(code_key(F.col("v"), df.schema["v"].dataType)).collect()}
    assert keys == {"1", "1.5", "NaN"}
    text = spark.createDataFrame([("071",)], "v string")
    assert text.select(code_key(F.col("v"), text.schema["v"].dataType)).first()[0] == "071"


def test_periods(spark):
    df = spark.sql("SELECT '2013-02-03' d")
    values = {
        grain: tuple(df.select(*period_columns(F.col("d"), grain).values()).first())
        for grain in ("year", "month", "year_month", "day_of_month", "day")
    }
    assert values == {
        "year": (2013,),
        "month": (2,),
        "year_month": (2013, 2),
        "day_of_month": (3,),
        "day": (dt.date(2013, 2, 3),),
    }
    with pytest.raises(ValueError, match="unknown grain"):
        period_columns(F.col("d"), "week")
