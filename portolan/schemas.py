"""Fixed schemas of the sources and of the five star-schema tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column names and types of the sources and of the output tables.
# Raw monthly arrivals: 28 columns, numeric codes arrive as doubles.
ARRIVALS_RAW = _struct(
    ("cicid", D), ("i94yr", D), ("i94mon", D), ("i94cit", D), ("i94res", D),
    ("i94port", S), ("arrdate", D), ("i94mode", D), ("i94addr", S),
    ("depdate", D), ("i94bir", D), ("i94visa", D), ("count", D),
    ("dtadfile", S), ("visapost", S), ("occup", S), ("entdepa", S),
    ("entdepd", S), ("entdepu", S), ("matflag", S), ("biryear", D),
    ("dtaddto", S), ("gender", S), ("insnum", S), ("airline", S),
    ("admnum", D), ("fltno", S), ("visatype", S),
)

# Columns of the raw arrivals that reach the fact table.
ARRIVALS_KEPT = ["cicid", "i94cit", "i94port", "arrdate", "i94mode", "i94addr",
                 "depdate", "i94bir", "i94visa", "visatype", "gender"]
# Kept double codes that the star stores as ints.
ARRIVALS_INT_CODES = ["cicid", "i94cit", "i94mode", "i94bir", "i94visa"]

# ';'-separated city demographics.
CITIES_RAW = _struct(
    ("City", S), ("State", S), ("Median Age", D), ("Male Population", I),
    ("Female Population", I), ("Total Population", I),
    ("Number of Veterans", I), ("Foreign-born", I),
    ("Average Household Size", D), ("State Code", S), ("Race", S), ("Count", I),
)

# City columns that stay: one row per city once Race and Count are gone.
CITIES_KEPT = [f.name for f in CITIES_RAW.fields][:10]

# ','-separated airport codes.
PORTS_RAW = _struct(
    ("ident", S), ("type", S), ("name", S), ("elevation_ft", I),
    ("continent", S), ("iso_country", S), ("iso_region", S),
    ("municipality", S), ("gps_code", S), ("iata_code", S), ("local_code", S),
    ("coordinates", S),
)

PORTS_KEPT = ["ident", "type", "name", "continent", "iso_region", "municipality", "iata_code"]

# ','-separated land temperatures by city.
TEMPERATURES_RAW = _struct(
    ("dt", T.DateType()), ("AverageTemperature", D),
    ("AverageTemperatureUncertainty", D), ("City", S), ("Country", S),
    ("Latitude", S), ("Longitude", S),
)

# Output tables, column order is the load contract.
FACT_IMMIGRATIONS = _struct(
    ("immigration_id", I), ("origin", I), ("landing_port", S),
    ("arrival_date", D), ("departure_date", D), ("arrival_mode", I),
    ("city", S), ("age", I), ("visa", I), ("visatype", S), ("gender", S),
)
DIM_TIME = _struct(("sas_timestamp", D), ("year", I), ("month", I), ("day", I),
                   ("week", I), ("weekday", I))
DIM_CITIES = _struct(
    ("city", S), ("state", S), ("median_age", D), ("male_pop", I),
    ("female_pop", I), ("total_pop", I), ("veterans", I), ("foreign_born", I),
    ("avg_household_size", D),
)
DIM_PORTS = _struct(("port_id", S), ("name", S), ("city", S), ("type", S),
                    ("iata_code", S), ("iso_region", S))
DIM_TEMPERATURES = _struct(("city", S), ("avg_temp", D), ("avg_temp_uncertainty", D))

# Table name -> (schema, declared key column).
STAR_TABLES = {
    "fact_immigrations": (FACT_IMMIGRATIONS, "immigration_id"),
    "dim_temperatures": (DIM_TEMPERATURES, "city"),
    "dim_ports": (DIM_PORTS, "port_id"),
    "dim_cities": (DIM_CITIES, "city"),
    "dim_time": (DIM_TIME, "sas_timestamp"),
}
