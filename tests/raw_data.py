"""Small raw tables with every oddity the dataflows have to handle."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

EXTRACT_SCHEMA = (
    "cicid double, i94yr double, i94mon double, i94port string, i94addr string, "
    "i94mode double, i94visa double, i94bir double, arrdate double, depdate double, "
    "biryear double, gender string, visatype string"
)


def arrival(cicid, **changes):
    row = {
        "cicid": float(cicid),
        "i94yr": 2016.0,
        "i94mon": 1.0,
        "i94port": "NYQ",
        "i94addr": "NY",
        "i94mode": 1.0,
        "i94visa": 2.0,
        "i94bir": 40.0,
        "arrdate": 20454.0,
        "depdate": 20464.0,
        "biryear": 1976.0,
        "gender": "F",
        "visatype": "B2",
    }
    row.update(changes)
    return tuple(row.values())


JANUARY = [
    arrival(1),
    arrival(1),  # an exact copy
    arrival(2),  # agrees with 1 in every column that is kept
    arrival(3, i94mode=2.0),
    arrival(4, i94mode=None),
    arrival(5, i94yr=None),
    arrival(6, i94mon=None),
    arrival(7, i94port=None),
    arrival(8, arrdate=None),
    arrival(9, i94bir=None),
    arrival(10, i94bir=float("nan")),
    arrival(11, depdate=None),
    arrival(12, depdate=20450.0),  # leaves before arriving
    arrival(13, gender=None, i94port="LAQ", i94visa=1.0),
    arrival(14, i94addr=None, i94port="ZZZ", i94visa=9.0),
]

JUNE = [arrival(20, i94mon=6.0, arrdate=20610.0, depdate=20611.0)]


def january(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(JANUARY, EXTRACT_SCHEMA)


def june(spark: SparkSession) -> DataFrame:
    """Two columns more, and the others in reverse order."""
    df = spark.createDataFrame(JUNE, EXTRACT_SCHEMA)
    return df.selectExpr("0.0D AS delete_days", *reversed(df.columns), "1.0D AS delete_mexl")


TEMPERATURE_CSV = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1999-12-31,1.5,0.2,New York,United States,40.99N,74.56W
2000-01-01,2.5,0.2,New York,United States,40.99N,74.56W
2013-01-01,4.5,0.2,New York,United States,40.99N,74.56W
2000-06-01,,,New York,United States,40.99N,74.56W
2000-06-01,21.0,0.3,Paris,France,49.03N,2.45E
2000-01-01,6.0,0.1,Winston/Salem,United States,36.17N,79.56W
2000-01-01,10.0,0.1,Springfield,United States,37.78N,93.56W
2000-01-01,20.0,0.1,Springfield,United States,39.38N,89.48W
"""

AIRPORT_CSV = '''ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
K1,large_airport,"Kennedy, John F.",13,NA,US,US-NY,New York,KJFK,NYQ,JFK,"-73.7, 40.6"
K2,small_airport,"The ""Old"" Field",,NA,US,US-IL,Springfield,,SPI,,"-89.6, 39.8"
K3,small_airport,No Code Field,5.5,NA,US,US-TX,Austin,,,,"-97, 30"
K4,large_airport,Hosea Kutako,5640,AF,NA,NA-KH,Windhoek,FYWH,WDH,,"17.4, -22.4"
K5,small_airport,Nowhere,1,NA,US,US-AK,,,NWH,,"-150, 60"
K6,small_airport,Springfield Branson,1268,NA,US,US-MO,Springfield,,SGF,,"-93.3, 37.2"
K7,small_airport,Birmingham GB,300,EU,GB,GB-NY,New York,,BHX,,"-1.7, 52.4"
'''

DEMOGRAPHICS_CSV = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;White;3835726
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Asian;1304564
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Hispanic or Latino;2485125
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Black;2192248
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Native;90923
Springfield;Illinois;38.0;55639;62170;117809;7525;4264;2.22;IL;White;90000
Springfield;Missouri;33.0;80000;86000;166000;9000;5000;2.1;MO;White;150000
Nocount;Ohio;33.0;10.0;20.0;30;1;2;2.1;OH;White;
Nomales;Ohio;33.0;;20;30;1;2;2.1;OH;White;5
Larger;Ohio;33.0;10;10;30;1;2;2.1;OH;White;5
Toosmall;Ohio;33.0;20;20;30;1;2;2.1;OH;White;5
Foreign;Ohio;33.0;10;20;30;1;30;2.1;OH;White;5
Crowded;Ohio;33.0;1;1;2;0;1;2.1;OH;White;5
Veteran;Ohio;33.0;10;20;30;10;2;2.1;OH;White;5
"""

ADDRESS_CODES = {"NY": "NEW YARD", "CA": "CALDERA", "77": "Elsewhere"}
PORT_CODES = {
    "NYQ": "NEW YARD, NY",
    "LAQ": "LOWER ARM, CA",
    "ZZZ": "UNKNOWN PLACE",
    "QFG": "Collapsed (QQQ) 01/02",
    "071": "No PORT Code (71)",
    ".QB": "No PORT Code (.QB)",
    "QIW": "INVALID - SOMEWHERE",
    "QA": "ALDERBY, NY",
    "7QE": "ALDERBY, NY",
}
VISA_CODES = {"1": "Work", "2": "Leisure", "3": "Study"}


def write_raw(spark: SparkSession, folder: Path) -> dict[str, str]:
    """All raw files of a lake below a folder; returns their paths."""
    months = {"jan": january(spark), "jun": june(spark)}
    paths = {"arrivals": []}
    for month, df in months.items():
        path = str(folder / f"i94_{month}16_sub")
        df.write.parquet(path)
        paths["arrivals"].append(path)
    texts = {
        "temperature": TEMPERATURE_CSV,
        "airports": AIRPORT_CSV,
        "demographics": DEMOGRAPHICS_CSV,
    }
    for name, text in texts.items():
        paths[name] = str(folder / f"{name}.csv")
        Path(paths[name]).write_text(text)
    maps = {"address_codes": ADDRESS_CODES, "port_codes": PORT_CODES, "visa_codes": VISA_CODES}
    for name, entries in maps.items():
        paths[name] = str(folder / f"{name}.json")
        Path(paths[name]).write_text(json.dumps(entries, indent=2))
    return paths
