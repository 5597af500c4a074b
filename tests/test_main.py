from __future__ import annotations

import json

import pytest

import raw_data
from landfall.__main__ import main, parse, sources
from landfall.sources import open_lake


@pytest.fixture
def arguments(spark, tmp_path):
    paths = raw_data.write_raw(spark, tmp_path)
    codes = tmp_path / "desc"
    codes.mkdir()
    for name, entries in {
        "address_desc": raw_data.ADDRESS_CODES,
        "airport_desc": raw_data.PORT_CODES,
        "visacode_desc": raw_data.VISA_CODES,
    }.items():
        (codes / f"{name}.json").write_text(json.dumps(entries, indent=2))
    return [
        "--arrivals", str(tmp_path / "i94_{month}16_sub"),
        "--months", "jan", "jun",
        "--temperature", paths["temperature"],
        "--airports", paths["airports"],
        "--demographics", paths["demographics"],
        "--codes", str(codes) + "/",
        "--base", str(tmp_path / "lake"),
    ]


def test_whole_run(spark, arguments, capsys):
    main(arguments)
    lake = open_lake(spark, arguments[-1], register=False)
    assert {name: df.count() for name, df in lake.items()} == {
        "immigration": 7,
        "temperature": 5,
        "airport_codes": 6,
        "demographics": 8,
        "address_desc": 3,
        "airport_desc": 9,
        "visacode_desc": 3,
    }
    assert "males_over_veterans" in capsys.readouterr().out


def test_some_tables_only(spark, arguments, tmp_path):
    main([*arguments, "--tables", "visacode_desc", "airport_codes"])
    found = sorted(path.name for path in (tmp_path / "lake").iterdir())
    assert found == ["airport_codes", "visacode_desc"]


def test_several_years_and_days(spark, arguments, tmp_path):
    main([*arguments, "--tables", "immigration", "--by-year", "--keep-arrival-date"])
    assert (tmp_path / "lake" / "immigration" / "year=2016" / "month=6").is_dir()
    fact = open_lake(spark, arguments[-1], ["immigration"], False, arrival_date=True)["immigration"]
    assert str(fact.where("month = 6").first().arrival_date) == "2016-06-05"
    assert "arrival_date" not in open_lake(spark, arguments[-1], ["immigration"])["immigration"].columns


def test_listed_extracts_are_taken_as_they_are(arguments):
    options = parse([*arguments, "--arrivals", "a", "b"])
    assert sources(options).arrivals == ["a", "b"]
    assert sources(parse(arguments)).arrivals[1].endswith("i94_jun16_sub")
