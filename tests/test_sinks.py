from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall.operators import no_nulls, rules
from landfall.sinks import write_table


@pytest.fixture
def months(spark):
    return spark.sql("SELECT id, CAST(id % 4 AS INT) AS month FROM range(40)")


def folders(path):
    return sorted(name for name in os.listdir(path) if "=" in name)


def data_files(path):
    return [name for name in os.listdir(path) if name.endswith(".parquet")]


def test_round_trip_moves_the_partition_column_last(spark, months, tmp_path):
    path = str(tmp_path / "t")
    report = write_table(months.select("month", "id"), path, ["month"])
    assert report.rows == 40
    back = spark.read.parquet(path)
    assert back.columns == ["id", "month"]
    assert rows(back) == rows(months)
    assert folders(path) == ["month=0", "month=1", "month=2", "month=3"]


def test_full_overwrite_replaces_the_table(spark, months, tmp_path):
    path = str(tmp_path / "t")
    write_table(months, path, ["month"])
    write_table(months.where("month = 1"), path, ["month"])
    assert folders(path) == ["month=1"]


def test_partition_overwrite_keeps_the_others(spark, months, tmp_path):
    path = str(tmp_path / "t")
    write_table(months, path, ["month"])
    write_table(months.where("month = 1").limit(2), path, ["month"], mode="partitions")
    counts = dict(spark.read.parquet(path).groupBy("month").count().collect())
    assert counts == {0: 10, 1: 2, 2: 10, 3: 10}


def test_unknown_mode(months, tmp_path):
    with pytest.raises(ValueError, match="unknown mode"):
        write_table(months, str(tmp_path / "t"), mode="append")


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(1, "Winston/Salem"), (2, None), (3, ""), (4, "1234"), (5, "NA"), (6, "a=b c")]
    write_table(spark.createDataFrame(data, "id int, city string"), path, ["city"])
    assert "city=Winston%2FSalem" in folders(path)
    assert "city=__HIVE_DEFAULT_PARTITION__" in folders(path)
    back = dict(spark.read.schema("id int, city string").parquet(path).collect())
    # A partition folder cannot tell an empty text from a missing one.
    assert back == {1: "Winston/Salem", 2: None, 3: None, 4: "1234", 5: "NA", 6: "a=b c"}


def test_checks_ride_along_on_the_write(spark, months, tmp_path):
    checks = [*no_nulls(months, ["id"]), *rules({"below_30": "id < 30"})]
    report = write_table(months, str(tmp_path / "t"), ["month"], checks=checks)
    assert report.checks == [("not_null", "id", 0), ("rule", "below_30", 10)]


def test_empty_table(spark, months, tmp_path):
    assert write_table(months.where("id < 0"), str(tmp_path / "t"), ["month"]).rows == 0


def test_hot_partition_is_written_by_several_tasks(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__shuffle__partitions="64",
    )
    wide = spark.range(0, 60000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).cast("int").alias("month"),
    )
    path = str(tmp_path / "t")
    assert write_table(wide, path, ["month"]).rows == 60000
    assert len(data_files(f"{path}/month=1")) > 4
    assert len(data_files(f"{path}/month=12")) == 1
    assert spark.read.parquet(path).count() == 60000


def test_without_adaptive_execution_no_shuffle_is_added(spark, settings, months, tmp_path):
    settings(spark__sql__adaptive__enabled="false")
    report = write_table(months, str(tmp_path / "t"), ["month"])
    assert report.rows == 40
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(months)


def test_rows_per_file_can_be_limited(spark, months, tmp_path):
    path = str(tmp_path / "t")
    write_table(months.coalesce(1), path, compact=False, max_records_per_file=10)
    assert len(data_files(path)) == 4
