"""Check states per partition, and bucketed tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import final_plan_of, plan_of, rows
from landfall.operators import at_least_two, check_unique, no_nulls, not_empty, rules, run_checks
from landfall.sinks import (
    bucketed_lookup,
    current_snapshot,
    hot_keys,
    open_bucketed,
    publish_checked,
    publish_table,
    read_snapshot,
    stored_checks,
    write_bucketed,
)


@pytest.fixture
def table(spark):
    return spark.sql(
        "SELECT id, CAST(id % 4 AS INT) AS month, IF(id % 5 = 0, NULL, id % 3) AS c,"
        " IF(id = 6, double('NaN'), id / 2) AS x, 'same' AS s FROM range(40)"
    )


def checks_of(df):
    return [not_empty(), at_least_two("c"), at_least_two("s"), *no_nulls(df, ["c", "x"]), *rules({"low": "x < 15"})]


def at_once(df):
    return rows(run_checks(df, checks_of(df)).unionByName(check_unique(df, ["id"])))


def test_combined_states_equal_checks_of_the_whole_table(spark, table, tmp_path):
    path = str(tmp_path / "t")
    publish_checked(table, path, ["month"], checks=checks_of(table), unique=["id"])
    assert rows(stored_checks(spark, path)) == at_once(table)
    march = table.where("month = 3")
    twice = march.unionByName(march).withColumn("c", F.lit(None).cast("bigint"))
    snapshot = publish_checked(twice, path, ["month"], "partitions", checks_of(table), ["id"])
    assert rows(stored_checks(spark, path)) == at_once(read_snapshot(spark, path))
    read = read_snapshot(spark, path, only_written=True).inputFiles()
    assert read and all(f"{snapshot.written}/month=3/" in name for name in read)


def test_only_new_rows_are_counted_after_a_refresh(spark, table, tmp_path):
    """The state of other months stays the file it was."""
    path = str(tmp_path / "t")
    publish_checked(table, path, ["month"], checks=checks_of(table))
    first = current_snapshot(spark, f"{path}/check_counts")
    publish_checked(table.where("month = 1"), path, ["month"], "partitions", checks_of(table))
    second = current_snapshot(spark, f"{path}/check_counts")
    assert second.folders[second.written] == ["month=1"]
    assert second.folders[first.written] == ["month=0", "month=2", "month=3"]


def test_states_of_unpartitioned_and_empty_tables(spark, table, tmp_path):
    path = str(tmp_path / "t")
    publish_checked(table, path, checks=checks_of(table), unique=["id"])
    assert rows(stored_checks(spark, path)) == at_once(table)
    other = str(tmp_path / "u")
    publish_checked(table.where("false"), other, checks=checks_of(table), unique=["id"])
    found = {(r.check_name, r.target): r.violations for r in stored_checks(spark, other).collect()}
    assert found["not_empty", "*"] == 1 and found["unique", "id"] == 0


def test_states_that_do_not_belong_to_the_table_are_refused(spark, table, tmp_path):
    path = str(tmp_path / "t")
    publish_checked(table, path, checks=checks_of(table))
    publish_table(table, path)
    with pytest.raises(ValueError, match="not those of its newest version"):
        stored_checks(spark, path)
    publish_table(table, str(tmp_path / "u"))
    with pytest.raises(ValueError, match="no stored checks"):
        stored_checks(spark, str(tmp_path / "u"))


@pytest.fixture
def star(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    facts = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 100 != 1, F.concat(F.lit("K"), F.col("id") % 97)).alias("code"),
    )
    dims = spark.range(90).select(F.concat(F.lit("K"), F.col("id")).alias("code"), F.col("id").alias("n"))
    dims = dims.union(spark.sql("SELECT 'HOT', 1000L"))
    hot = hot_keys(facts, "code", 8)
    yield (
        facts, dims, hot,
        write_bucketed(facts, str(tmp_path / "facts"), "test_facts", "code", 8, hot),
        write_bucketed(dims, str(tmp_path / "dims"), "test_dims", "code", 8, hot, is_fact=False),
        tmp_path,
    )
    for name in ("test_facts", "test_dims", "test_again"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_tables_are_joined_without_a_shuffle(spark, star):
    facts, dims, hot, stored, dimension, _ = star
    assert hot == [("HOT", 3)]
    joined = bucketed_lookup(stored, dimension, "code")
    assert "Exchange" not in plan_of(joined) and "Exchange" not in final_plan_of(joined)
    assert "SelectedBucketsCount" in plan_of(joined)
    assert joined.columns == ["id", "code", "n"]
    assert rows(joined) == rows(facts.join(dims, "code", "left").select("id", "code", "n"))


def test_a_hot_key_is_dealt_over_buckets(spark, star):
    _, _, _, stored, dimension, _ = star
    assert stored.where("code = 'HOT'").select("bucket_salt").distinct().count() == 3
    assert dimension.where("code = 'HOT'").count() == 3
    per_salt = [r["count"] for r in stored.where("code = 'HOT'").groupBy("bucket_salt").count().collect()]
    assert max(per_salt) < 2 * min(per_salt)


def test_a_bucketed_table_can_be_opened_by_another_session(spark, star):
    facts, dims, _, stored, dimension, folder = star
    wanted = rows(bucketed_lookup(stored, dimension, "code"))
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    a = open_bucketed(other, str(folder / "facts"), "test_facts")
    b = open_bucketed(other, str(folder / "dims"), "test_again")
    joined = bucketed_lookup(a, b, "code")
    assert "Exchange" not in plan_of(joined)
    assert rows(joined) == wanted
