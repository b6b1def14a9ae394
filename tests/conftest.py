from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portolan.schemas import ARRIVALS_RAW, CITIES_RAW, PORTS_RAW, TEMPERATURES_RAW  # noqa: E402
from portolan.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="portolan-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _rows(schema, rows: list[dict], defaults: dict):
    out = []
    for r in rows:
        full = {**defaults, **r}
        out.append(tuple(full.get(f.name) for f in schema.fields))
    return out


ARRIVAL_DEFAULTS = {
    "cicid": 1.0, "i94yr": 2016.0, "i94mon": 1.0, "i94cit": 101.0, "i94res": 101.0,
    "i94port": "ORL", "arrdate": 20454.0, "i94mode": 1.0, "i94addr": "FL", "depdate": 20460.0,
    "i94bir": 30.0, "i94visa": 2.0, "count": 1.0, "visatype": "WT", "gender": "F",
    "admnum": 1.0, "airline": "XX",
}


def arrivals(spark, rows: list[dict]):
    return spark.createDataFrame(_rows(ARRIVALS_RAW, rows, ARRIVAL_DEFAULTS), ARRIVALS_RAW)


CITY_DEFAULTS = {
    "City": "Orlando", "State": "Florida", "Median Age": 33.1, "Male Population": 100,
    "Female Population": 110, "Total Population": 210, "Number of Veterans": 5,
    "Foreign-born": 20, "Average Household Size": 2.5, "State Code": "FL",
    "Race": "Asian", "Count": 10,
}


def cities(spark, rows: list[dict]):
    return spark.createDataFrame(_rows(CITIES_RAW, rows, CITY_DEFAULTS), CITIES_RAW)


PORT_DEFAULTS = {
    "ident": "KORL", "type": "medium_airport", "name": "Orlando Executive", "elevation_ft": 113,
    "continent": "NA", "iso_country": "US", "iso_region": "US-FL", "municipality": "Orlando",
    "iata_code": "ORL",
}


def ports(spark, rows: list[dict]):
    return spark.createDataFrame(_rows(PORTS_RAW, rows, PORT_DEFAULTS), PORTS_RAW)


TEMP_DEFAULTS = {"AverageTemperature": 20.0, "AverageTemperatureUncertainty": 1.0,
                 "City": "Orlando", "Country": "United States"}


def temperatures(spark, rows: list[dict]):
    return spark.createDataFrame(_rows(TEMPERATURES_RAW, rows, TEMP_DEFAULTS), TEMPERATURES_RAW)
