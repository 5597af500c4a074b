from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import raw_data
from conftest import plan_of, rows
from landfall.operators import QualityError, StepCounter, run_checks, union_extracts
from landfall.plans import (
    LakeSources,
    airport_checks,
    build_lake,
    conform_airports,
    conform_arrivals,
    conform_demographics,
    conform_temperature,
    demographics_checks,
)
from landfall.schemas import (
    AIRPORT_CSV,
    DEMOGRAPHICS_CSV,
    LAKE_SCHEMAS,
    TEMPERATURE_CSV,
)
from landfall.sources import open_lake, read_csv
from landfall.sinks import write_table


def types(schema):
    return [(field.name, field.dataType) for field in schema]


@pytest.fixture
def extracts(spark):
    return union_extracts([raw_data.january(spark), raw_data.june(spark)])


@pytest.fixture
def raw_paths(spark, tmp_path):
    return raw_data.write_raw(spark, tmp_path)


def test_arrivals(extracts):
    fact = conform_arrivals(extracts)
    assert types(fact.schema) == types(LAKE_SCHEMAS["immigration"])
    found = rows(fact)
    usual = (2016, 1, "NYQ", "NY", 2.0, 1976.0, "F", "B2", 10.0)
    # Travellers 1 and 2 agree in all kept columns and must both remain.
    assert found.count(usual) == 2
    assert (2016, 1, "NYQ", "NY", 2.0, 1976.0, "F", "B2", None) in found
    assert (2016, 1, "NYQ", "NY", 2.0, 1976.0, "F", "B2", -4.0) in found
    assert (2016, 1, "LAQ", "NY", 1.0, 1976.0, None, "B2", 10.0) in found
    assert (2016, 6, "NYQ", "NY", 2.0, 1976.0, "F", "B2", 1.0) in found
    assert len(found) == 7


def test_arrivals_with_their_date(spark, extracts):
    dated = conform_arrivals(extracts, keep_arrival_date=True)
    assert dated.columns == [*LAKE_SCHEMAS["immigration"].fieldNames(), "arrival_date"]
    assert dated.where("month = 6").first().arrival_date == dt.date(2016, 6, 5)
    as_dates = extracts.withColumns(
        {
            name: F.date_add(F.lit("1960-01-01").cast("date"), F.col(name).cast("int"))
            for name in ("arrdate", "depdate")
        }
    )
    assert rows(conform_arrivals(as_dates, keep_arrival_date=True)) == rows(dated)


def test_arrival_filters_sit_below_the_deduplication(spark, extracts, tmp_path):
    extracts.write.parquet(str(tmp_path / "raw"))
    plan = plan_of(conform_arrivals(spark.read.parquet(str(tmp_path / "raw"))))
    assert plan.index("HashAggregate") < plan.index("Filter")
    for pushed in ("EqualTo(i94mode,1.0)", "IsNotNull(i94port)", "IsNotNull(arrdate)"):
        assert pushed in plan
    assert plan.count("Exchange") == 1


def test_arrival_step_counts(extracts):
    counter = StepCounter()
    conform_arrivals(extracts, counter=counter).write.format("noop").mode("overwrite").save()
    assert counter.counts() == {"read": 16, "distinct": 15, "by_air": 13, "complete": 7}


def test_temperature(spark, raw_paths):
    raw = read_csv(spark, raw_paths["temperature"], TEMPERATURE_CSV)
    kept = conform_temperature(raw)
    assert types(kept.schema) == types(LAKE_SCHEMAS["temperature"])
    assert sorted((r.city, r.dt) for r in kept.collect()) == [
        ("New York", "2000-01-01"),
        ("New York", "2013-01-01"),
        ("Springfield", "2000-01-01"),
        ("Springfield", "2000-01-01"),
        ("Winston/Salem", "2000-01-01"),
    ]
    assert conform_temperature(raw, country="France").count() == 1
    assert conform_temperature(raw, from_day="2013-01-01").count() == 1


def test_airports(spark, raw_paths):
    kept = conform_airports(read_csv(spark, raw_paths["airports"], AIRPORT_CSV))
    assert types(kept.schema) == types(LAKE_SCHEMAS["airport_codes"])
    codes = {r.airport_code: r for r in kept.collect()}
    assert set(codes) == {"NYQ", "SPI", "WDH", "NWH", "SGF", "BHX"}
    assert codes["WDH"].iso_country == "NA"
    assert codes["SPI"].elevation_ft is None
    assert codes["NWH"].municipality is None


def test_airport_check_fails_on_a_missing_name(spark, raw_paths):
    kept = conform_airports(read_csv(spark, raw_paths["airports"], AIRPORT_CSV))
    assert all(r.passed for r in run_checks(kept, airport_checks(kept)).collect())
    nameless = kept.withColumn("airport_name", F.nullif("airport_name", F.lit("Nowhere")))
    verdict = {r.target: r.violations for r in run_checks(nameless, airport_checks(nameless)).collect()}
    assert verdict == {"airport_name": 1, "airport_code": 0}


def test_demographics(spark, raw_paths):
    raw = read_csv(spark, raw_paths["demographics"], DEMOGRAPHICS_CSV, sep=";")
    kept = conform_demographics(raw)
    assert types(kept.schema) == types(LAKE_SCHEMAS["demographics"])
    cities = sorted((r.city, r.state_code) for r in kept.collect())
    # Five races make one city; a missing count or number of males removes the row.
    assert cities.count(("New York", "NY")) == 1
    assert [c for c, _ in cities if c in ("Nocount", "Nomales")] == []
    assert len(cities) == 8
    verdict = run_checks(kept, demographics_checks()).collect()
    assert {r.target: r.violations for r in verdict} == {
        "population_covers_sexes": 1,
        "population_over_foreign_born": 1,
        "population_over_household": 1,
        "males_over_veterans": 1,
    }


def test_whole_lake(spark, raw_paths, tmp_path):
    base = str(tmp_path / "lake")
    report = build_lake(spark, LakeSources(**raw_paths), base)
    failed = sorted((r.table_name, r.target, r.violations) for r in report.where("NOT passed").collect())
    assert failed == [
        ("demographics", "males_over_veterans", 1),
        ("demographics", "population_covers_sexes", 1),
        ("demographics", "population_over_foreign_born", 1),
        ("demographics", "population_over_household", 1),
        ("immigration", "stay_not_negative", 1),
    ]
    lake = open_lake(spark, base)
    counts = {name: df.count() for name, df in lake.items()}
    assert counts == {
        "immigration": 7,
        "temperature": 5,
        "airport_codes": 6,
        "demographics": 8,
        "address_desc": 3,
        "airport_desc": 9,
        "visacode_desc": 3,
    }
    assert {r.rows_checked for r in report.where("table_name = 'immigration'").collect()} == {7}
    answer = spark.sql("SELECT month, count(*) AS n FROM immigration GROUP BY month")
    assert rows(answer) == [(1, 6), (6, 1)]
    assert lake["airport_codes"].where("iso_country = 'NA'").count() == 1
    assert lake["temperature"].where("city = 'Winston/Salem'").count() == 1


def test_refresh_of_one_table_and_one_month(spark, raw_paths, tmp_path):
    base = str(tmp_path / "lake")
    by_year = {"arrival_partitions": ("year", "month")}
    sources = LakeSources(**raw_paths, **by_year)
    build_lake(spark, sources, base, tables=["immigration", "airport_codes"])
    june_only = LakeSources(**{**raw_paths, "arrivals": raw_paths["arrivals"][1:]}, **by_year)
    report = build_lake(spark, june_only, base, tables=["immigration"], mode="partitions")
    fact = open_lake(spark, base, ["immigration"])["immigration"]
    assert rows(fact.groupBy("month").count()) == [(1, 6), (6, 1)]
    counted = report.where("check_name = 'row_count'").first()
    assert (counted.violations, counted.rows_checked) == (0, 1)


def test_refresh_by_month_alone_is_refused(spark, raw_paths, tmp_path):
    with pytest.raises(ValueError, match="year"):
        build_lake(spark, LakeSources(**raw_paths), str(tmp_path / "lake"), mode="partitions")


def test_refresh_leaves_other_years(spark, tmp_path):
    path = str(tmp_path / "t")
    years = spark.createDataFrame([(2016, 3, 1), (2016, 4, 2), (2017, 3, 3)], "year int, month int, n int")
    write_table(years, path, ["year", "month"])
    write_table(years.where("year = 2017").withColumn("n", F.lit(9)), path, ["year", "month"], mode="partitions")
    found = spark.read.parquet(path).select("year", "month", "n")
    assert rows(found) == [(2016, 3, 1), (2016, 4, 2), (2017, 3, 9)]


def test_an_empty_list_of_tables_writes_nothing(spark, raw_paths, tmp_path):
    base = tmp_path / "lake"
    assert build_lake(spark, LakeSources(**raw_paths), str(base), tables=[]).count() == 0
    assert not base.exists()
    assert open_lake(spark, str(base), []) == {}


def test_repeated_dimension_keys_are_reported(spark, raw_paths, tmp_path):
    again = raw_data.AIRPORT_CSV + raw_data.AIRPORT_CSV.splitlines()[1] + "\n"
    path = tmp_path / "again.csv"
    path.write_text(again)
    sources = LakeSources(**{**raw_paths, "airports": str(path)})
    report = build_lake(spark, sources, str(tmp_path / "lake"), tables=["airport_codes"])
    unique = report.where("check_name = 'unique'").first()
    assert (unique.target, unique.violations, unique.rows_checked) == ("airport_code", 1, 7)


def test_a_run_reads_only_the_sources_it_needs(spark, raw_paths, tmp_path):
    nowhere = {name: str(tmp_path / "nowhere") for name in raw_paths if name != "visa_codes"}
    sources = LakeSources(**{**nowhere, "visa_codes": raw_paths["visa_codes"]})
    report = build_lake(spark, sources, str(tmp_path / "lake"), tables=["visacode_desc"])
    assert report.where("passed").count() == report.count() == 5


def test_strict_run_stops_before_it_writes(spark, raw_paths, tmp_path):
    base = tmp_path / "lake"
    with pytest.raises(QualityError, match="demographics: rule"):
        build_lake(spark, LakeSources(**raw_paths), str(base), tables=["demographics"], strict=True)
    assert not base.exists()
