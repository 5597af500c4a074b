from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import raw_data
from conftest import final_plan_of, plan_of, rows
from landfall.operators import decode, key_coverage, left_lookup, stay_stats, top_k, unmatched_keys
from landfall.plans import (
    LakeSources,
    airport_city_profile,
    airport_demographics,
    airport_temperature,
    arrivals_by_month,
    build_lake,
    conform_arrivals,
    decoded_arrivals,
    demographics_temperature,
    enrich_airport,
    snowflake,
    temperature_by,
    top_ports,
    weather_at_peaks,
)
from landfall.sources import open_lake, read_extracts


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    return LakeSources(**raw_data.write_raw(spark, tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def lake(spark, sources, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    build_lake(spark, sources, base)
    return open_lake(spark, base, register=False)


def code_map(spark, entries):
    return spark.createDataFrame(list(entries.items()), "key string, value string")


def test_decode_keeps_unknown_and_missing_codes(spark):
    df = spark.createDataFrame([(1, "NY"), (2, "??"), (3, None)], "id int, code string")
    decoded = decode(df, "code", code_map(spark, raw_data.ADDRESS_CODES), "name")
    assert rows(decoded) == [(1, "NY", "NEW YARD"), (2, "??", None), (3, None, None)]


def test_decode_numbers_against_text_keys(spark):
    codes = code_map(spark, {**raw_data.VISA_CODES, "ALC": "not a number"})
    for kind in ("double", "int", "bigint", "float", "decimal(5,1)", "string"):
        df = spark.sql(f"SELECT CAST('2' AS {kind}) AS v UNION ALL SELECT CAST('9' AS {kind})")
        names = {row.name for row in decode(df, "v", codes, "name").collect()}
        assert names == {"Leisure", None}


def test_decode_does_not_match_fractions(spark):
    df = spark.sql("SELECT 1.5D AS v")
    assert decode(df, "v", code_map(spark, raw_data.VISA_CODES), "name").first().name is None


def test_placeholders(spark):
    df = spark.createDataFrame([(code,) for code in [*raw_data.PORT_CODES, "???"]], "code string")
    codes = code_map(spark, raw_data.PORT_CODES)
    flagged = decode(df, "code", codes, "name", "placeholder").where("placeholder").collect()
    assert {row.code for row in flagged} == {"ZZZ", "QFG", "071", ".QB", "QIW"}


def test_small_code_map_is_broadcast_by_spark(spark, lake):
    plan = plan_of(decode(lake["immigration"], "airport_code", lake["airport_desc"], "name"))
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_a_dimension_beyond_the_limit_is_not_broadcast(spark, settings, lake):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    joined = decode(lake["immigration"], "airport_code", lake["airport_desc"], "name")
    assert "Broadcast" not in final_plan_of(joined)
    assert joined.count() == lake["immigration"].count()


def test_hot_key_is_split_when_both_sides_are_large(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
        spark__sql__shuffle__partitions="16",
    )
    fact = spark.range(0, 60000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 997)).alias("code"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    codes = spark.range(997).select(
        F.concat(F.lit("K"), F.col("id")).alias("key"), F.col("id").cast("string").alias("value")
    ).union(spark.sql("SELECT 'HOT', 'hot'"))
    joined = decode(fact, "code", codes, "name")
    assert "skew=true" in final_plan_of(joined)
    assert joined.where("name = 'hot'").count() == 20000
    assert joined.where("name IS NOT NULL").count() == 60000


def test_two_joins_on_one_hot_key_are_both_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
        spark__sql__adaptive__forceOptimizeSkewedJoin="true",
        spark__sql__shuffle__partitions="16",
    )
    # A third of the facts has one code, and their rows meet a NULL city in the third join.
    fact = spark.range(0, 60000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 997)).alias("airport_code"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    codes = spark.range(997).select(
        F.concat(F.lit("K"), F.col("id")).alias("key"), F.col("id").cast("string").alias("value")
    ).union(spark.sql("SELECT 'HOT', 'hot'"))
    airports = codes.select(F.col("key").alias("airport_code"), F.nullif("value", F.lit("hot")).alias("municipality"))
    cities = spark.range(997).select(F.col("id").cast("string").alias("city"), "id")
    decoded = decode(fact, "airport_code", codes, "name")
    located = enrich_airport(decoded, airports)
    both = final_plan_of(located)
    assert both[: both.index("== Initial Plan ==")].count("SortMergeJoin(skew=true)") == 2
    peopled = left_lookup(located, cities.withColumnRenamed("id", "people"), [("municipality", "city")])
    three = final_plan_of(peopled)
    assert three[: three.index("== Initial Plan ==")].count("SortMergeJoin(skew=true)") == 3
    assert peopled.count() == 60000 and peopled.where("people IS NULL").count() == 20000


def test_lookup_on_two_keys_and_fan_out(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 1, "z")], "k string, n int, v string")
    assert rows(left_lookup(left, right, [("k", "k"), ("n", "n")])) == [
        ("a", 1, "x"),
        ("a", 1, "z"),
        ("b", 2, None),
        (None, 3, None),
    ]


def test_coverage(spark, lake):
    assert rows(key_coverage(lake["immigration"], lake["airport_codes"], ("airport_code", "airport_code"))) == [
        (7, 5, 2)
    ]
    assert rows(unmatched_keys(lake["immigration"], lake["airport_codes"], ("airport_code", "airport_code"))) == [
        ("LAQ", 1),
        ("ZZZ", 1),
    ]
    nobody = lake["immigration"].limit(0)
    assert rows(key_coverage(nobody, lake["airport_codes"], ("airport_code", "airport_code"))) == [(0, 0, 0)]


def test_coverage_counts_before_it_joins(lake):
    plan = plan_of(key_coverage(lake["immigration"], lake["airport_codes"], ("airport_code", "airport_code")))
    join = plan.index("Join")
    assert "partial_count(1)" in plan[join:]


def test_coverage_of_missing_keys_and_repeated_dimension_rows(spark):
    fact = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(key_coverage(fact, dim, ("k", "k"))) == [(4, 2, 2)]


def test_edges(lake):
    airports, cities, weather = lake["airport_codes"], lake["demographics"], lake["temperature"]
    assert enrich_airport(lake["immigration"], airports).count() == 7
    by_state = {r.airport_code: r.population for r in airport_demographics(airports, cities).collect()}
    assert by_state == {"NYQ": 8550405, "SPI": 117809, "SGF": 166000, "WDH": None, "NWH": None, "BHX": None}
    by_city = airport_demographics(airports, cities, match_state=False)
    assert by_city.where("airport_code = 'SPI'").count() == 2
    warm = {r.airport_code: r.avg_temperature for r in airport_temperature(airports, weather).collect()}
    assert warm["SPI"] == 15.0 and warm["NYQ"] == 3.5 and warm["WDH"] is None
    assert demographics_temperature(cities, weather).where("city = 'Springfield'").count() == 2
    assert rows(temperature_by(weather.where("city = 'New York'"), "year_month")) == [
        ("New York", 2000, 1, 2.5, 1),
        ("New York", 2013, 1, 4.5, 1),
    ]


def test_snowflake_keeps_every_arrival_once(lake):
    whole = snowflake(lake)
    assert whole.count() == 7
    january = whole.where("month = 1 AND airport_code = 'NYQ' AND stay_duration = 10").first()
    assert january.address_name == "NEW YARD"
    assert january.port_name == "NEW YARD, NY"
    assert january.visa_name == "Leisure"
    assert january.airport_name == "Kennedy, John F."
    assert january.population == 8550405
    assert january.avg_temperature == 3.5
    assert whole.where("month = 6").first().avg_temperature is None
    unknown = whole.where("airport_code = 'ZZZ'").first()
    assert unknown.is_placeholder and unknown.visa_name is None and unknown.airport_name is None


def test_snowflake_moves_no_fact_rows_while_dimensions_are_small(lake):
    plan = plan_of(snowflake(lake))
    assert "SortMergeJoin" not in plan
    facts = plan.index("immigration")
    exchanges = [i for i in range(len(plan)) if plan.startswith("Exchange hashpartitioning", i)]
    # The only shuffle averages the temperatures, which are printed after the facts.
    assert len(exchanges) == 1 and exchanges[0] > facts


def test_questions(lake, sources, spark):
    assert [tuple(r) for r in arrivals_by_month(lake["immigration"]).collect()] == [(2016, 1, 6), (2016, 6, 1)]
    ports = [tuple(r) for r in top_ports(lake["immigration"], lake["airport_desc"], 2).collect()]
    assert ports == [("NYQ", 5, "NEW YARD, NY", False), ("LAQ", 1, "LOWER ARM, CA", False)]
    assert decoded_arrivals(lake).where("visa_name = 'Work'").count() == 1
    profile = {r.airport_code: r for r in airport_city_profile(lake).collect()}
    assert profile["NYQ"].arrivals == 5 and profile["NYQ"].population == 8550405
    assert profile["ZZZ"].municipality is None
    peaks = weather_at_peaks(lake["immigration"], lake["airport_codes"], lake["temperature"], k=5)
    assert [tuple(r) for r in peaks.collect()] == [
        ("NYQ", 1, 4, "New York", 3.5, 2),
        ("LAQ", 1, 1, None, None, None),
        ("NYQ", 6, 1, "New York", None, None),
        ("ZZZ", 1, 1, None, None, None),
    ]
    with pytest.raises(ValueError, match="arrival_date"):
        weather_at_peaks(lake["immigration"], lake["airport_codes"], lake["temperature"], grain="day")
    dated = conform_arrivals(read_extracts(spark, sources.arrivals), keep_arrival_date=True)
    days = weather_at_peaks(dated, lake["airport_codes"], lake["temperature"], k=1, grain="day")
    assert days.first().arrivals == 4 and str(days.first().day) == "2016-01-01"


def test_stay_statistics(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 6.0), ("a", None), ("b", -1.0), ("c", None)],
        "k string, stay_duration double",
    )
    assert rows(stay_stats(df, ["k"])) == [
        ("a", 3.0, 2.0, 1.0, 6.0, 3),
        ("b", -1.0, -1.0, -1.0, -1.0, 1),
        ("c", None, None, None, None, 0),
    ]


def test_stay_statistics_skip_nan_and_take_fractions(spark):
    stays = [("a", 1.5), ("a", float("nan")), ("a", 2.25), ("a", 2.25), ("a", 9.0), ("b", float("nan"))]
    df = spark.createDataFrame(stays, "k string, stay_duration double")
    assert rows(stay_stats(df, ["k"])) == [("a", 3.75, 2.25, 1.5, 9.0, 4), ("b", None, None, None, None, 0)]


def test_top_k_never_sorts_the_whole_table(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in top_k(df, ["k"], 2).collect()] == [("c", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in plan_of(top_k(df, ["k"], 2))
