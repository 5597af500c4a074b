from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

import raw_data
from conftest import plan_of, rows
from landfall.schemas import AIRPORT_CSV, DEMOGRAPHICS_CSV, MONTHS, PANDAS_NA_TOKENS, TEMPERATURE_CSV
from landfall.sources import (
    monthly_paths,
    open_lake,
    read_code_map,
    read_csv,
    read_extract,
    read_extracts,
)


def file_with(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_monthly_paths_start_with_january():
    paths = monthly_paths("s3a://raw/i94_{month}16_sub.sas7bdat")
    assert len(paths) == 12 and MONTHS[0] == "jan"
    assert paths[0] == "s3a://raw/i94_jan16_sub.sas7bdat"
    assert paths[11] == "s3a://raw/i94_dec16_sub.sas7bdat"


def test_extracts_follow_the_first_ones_columns(spark, tmp_path):
    paths = raw_data.write_raw(spark, tmp_path)["arrivals"]
    united = read_extracts(spark, paths)
    assert united.columns == raw_data.january(spark).columns
    assert united.count() == len(raw_data.JANUARY) + len(raw_data.JUNE)
    assert united.where("i94mon = 6").first().cicid == 20.0


def test_extract_without_a_contract_column_fails(spark, tmp_path):
    paths = raw_data.write_raw(spark, tmp_path)["arrivals"]
    short = str(tmp_path / "feb")
    raw_data.january(spark).drop("gender", "i94addr").write.parquet(short)
    with pytest.raises(ValueError, match="i94addr, gender"):
        read_extracts(spark, [*paths, short])


def test_extract_format_and_schema_are_the_callers(spark, tmp_path):
    path = str(tmp_path / "j")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.json(path)
    typed = read_extract(spark, path, fmt="json", schema="b string, a double")
    assert rows(typed) == [("x", 1.0)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = file_with(tmp_path, "b;a;extra\nx;1;9\ny;2;9\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert rows(read_csv(spark, path, schema, sep=";")) == [(1, "x"), (2, "y")]
    wrong = T.StructType([T.StructField("zz", T.LongType())])
    with pytest.raises(ValueError, match="zz"):
        read_csv(spark, path, wrong, sep=";")


def test_csv_quotes_and_commas(spark, tmp_path):
    airports = read_csv(spark, file_with(tmp_path, raw_data.AIRPORT_CSV), AIRPORT_CSV)
    found = {r.ident: (r.name, r.elevation_ft, r.coordinates) for r in airports.collect()}
    assert found["K1"] == ("Kennedy, John F.", 13.0, "-73.7, 40.6")
    assert found["K2"] == ('The "Old" Field', None, "-89.6, 39.8")
    assert airports.schema == AIRPORT_CSV


def test_csv_na_text_stays_unless_named(spark, tmp_path):
    path = file_with(tmp_path, raw_data.AIRPORT_CSV)
    assert read_csv(spark, path, AIRPORT_CSV).where("iso_country = 'NA'").count() == 1
    as_pandas = read_csv(spark, path, AIRPORT_CSV, na_tokens=PANDAS_NA_TOKENS)
    assert as_pandas.where("iso_country IS NULL").count() == 1
    assert as_pandas.where("continent IS NULL").count() == 5


def test_csv_empty_and_quoted_empty_are_missing(spark, tmp_path):
    path = file_with(tmp_path, 'a,b\n,1\n"",2\nx,3\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert rows(read_csv(spark, path, schema)) == [("x", 3), (None, 1), (None, 2)]


def test_csv_malformed_number_raises(spark, tmp_path):
    path = file_with(tmp_path, "dt,v\n2000-01-01,12x\n")
    schema = T.StructType([T.StructField("dt", T.StringType()), T.StructField("v", T.DoubleType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        read_csv(spark, path, schema).collect()


@pytest.mark.parametrize("line", ["2000-01-01", "2000-01-01,1,2"])
def test_csv_line_with_the_wrong_number_of_values_raises(spark, tmp_path, line):
    path = file_with(tmp_path, f"dt,v\n1999-01-01,1\n{line}\n")
    schema = T.StructType([T.StructField("dt", T.StringType()), T.StructField("v", T.DoubleType())])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv(spark, path, schema).collect()


def test_csv_files_with_different_headers_raise(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    schema = T.StructType([T.StructField(name, T.LongType()) for name in "ab"])
    with pytest.raises(Exception):
        read_csv(spark, str(folder), schema).collect()


def test_csv_line_breaks_in_values(spark, tmp_path):
    path = file_with(tmp_path, 'a,b\n"two\nlines",1\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert rows(read_csv(spark, path, schema, multi_line=True)) == [("two\nlines", 1)]


def test_csv_of_demographics_and_temperature(spark, tmp_path):
    demographics = read_csv(
        spark, file_with(tmp_path, raw_data.DEMOGRAPHICS_CSV), DEMOGRAPHICS_CSV, sep=";"
    )
    assert demographics.where("Count IS NULL").first().City == "Nocount"
    assert demographics.where("City = 'Nocount'").first()["Male Population"] == 10.0
    path = file_with(tmp_path, raw_data.TEMPERATURE_CSV, "temperature.csv")
    assert read_csv(spark, path, TEMPERATURE_CSV).count() == 8


def test_code_map_of_a_pretty_printed_object(spark, tmp_path):
    path = tmp_path / "ports.json"
    path.write_text(json.dumps(raw_data.PORT_CODES, indent=2))
    (tmp_path / "notes.ipynb").write_text("{}")
    assert rows(read_code_map(spark, str(tmp_path))) == sorted(raw_data.PORT_CODES.items(), key=repr)


def test_code_map_with_an_object_per_line(spark, tmp_path):
    path = tmp_path / "ports.json"
    lines = [json.dumps({key: value}) for key, value in raw_data.PORT_CODES.items()]
    path.write_text("\n".join([lines[0], "", *lines[1:]]))
    found = read_code_map(spark, str(tmp_path), by_line=True)
    assert rows(found) == sorted(raw_data.PORT_CODES.items(), key=repr)


def test_code_map_that_is_not_json_raises(spark, tmp_path):
    path = tmp_path / "ports.json"
    path.write_text("not json")
    with pytest.raises(Exception):
        read_code_map(spark, str(path)).collect()


def test_lake_views_prune_partitions_and_columns(spark, tmp_path):
    from landfall.sinks import write_table

    df = spark.sql("SELECT 2016 AS year, CAST(id % 3 AS INT) AS month, 'NYQ' AS airport_code FROM range(9)")
    write_table(df, str(tmp_path / "immigration"), ["month"])
    open_lake(spark, str(tmp_path), ["immigration"])
    answer = spark.sql("SELECT airport_code, count(*) AS n FROM immigration WHERE month = 1 GROUP BY 1")
    assert rows(answer) == [("NYQ", 3)]
    plan = plan_of(answer)
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "ReadSchema: struct<airport_code:string>" in plan
