"""The four dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.dates import sas_to_date, time_parts
from portolan.functions.nulls import complete_rows
from portolan.functions.text import region_suffix
from portolan.operators.joins import join_using, semi_join

# Source column -> dim_cities column.
CITY_COLUMNS = {
    "City": "city",
    "State": "state",
    "Median Age": "median_age",
    "Male Population": "male_pop",
    "Female Population": "female_pop",
    "Total Population": "total_pop",
    "Number of Veterans": "veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "avg_household_size",
}


def cities_ports_combined(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Name-only match of cleaned cities and ports, full-row distinct.

    The wide many-to-many form; the dimensions below use existence joins
    instead so that neither side is repeated per partner. Both sides are
    made distinct before the join: for an inner equi-join that keeps every
    column, distinct(A join B) = distinct(A) join distinct(B), so the
    distinct shuffles the inputs instead of the (larger) joined pairs, and
    no pair is produced twice.
    """
    return cities.dropDuplicates().join(ports.dropDuplicates(),
                                        F.col("City") == F.col("municipality"), "inner")


def dim_ports(ports: DataFrame, cities: DataFrame) -> DataFrame:
    """Ports located in a known city; one row per distinct port record.

    ``iso_region`` keeps only the state part ('US-CA' -> 'CA').
    """
    matched = semi_join(ports, cities.select(F.col("City").alias("_city")),
                        F.col("municipality") == F.col("_city"))
    return matched.select(
        F.col("ident").alias("port_id"),
        "name",
        F.col("municipality").alias("city"),
        "type",
        "iata_code",
        region_suffix("iso_region").alias("iso_region"),
    ).dropDuplicates()


def dim_cities(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Cities that have at least one port; one row per distinct city record.

    Rows differing only in the dropped Race/Count collapse to one; a name in
    two states stays two rows (the grain is city and state).
    """
    matched = semi_join(cities, ports.select(F.col("municipality").alias("_muni")),
                        F.col("City") == F.col("_muni"))
    return matched.select(*[F.col(f"`{src}`").alias(dst) for src, dst in CITY_COLUMNS.items()]
                          ).dropDuplicates()


def distinct_dates(df: DataFrame, cols: list[str], name: str = "sas_timestamp") -> DataFrame:
    """Distinct non-missing values of several date columns, as one column.

    One scan and one aggregation (explode of a small array) instead of a
    union of per-column distincts.
    """
    out = df.select(F.explode(F.array(*cols)).alias(name))
    return out.filter(complete_rows(out)).distinct()


def dim_time(fact: DataFrame) -> DataFrame:
    """One row per distinct arrival or departure day number of the fact."""
    dates = distinct_dates(fact, ["arrival_date", "departure_date"])
    parts = time_parts(sas_to_date("sas_timestamp"))
    return dates.select("sas_timestamp", *[c.alias(n) for n, c in parts.items()])


def dim_temperatures(temps: DataFrame) -> DataFrame:
    """Average temperature and uncertainty per city, in one aggregation."""
    return temps.groupBy("city").agg(
        F.avg("avg_temp").alias("avg_temp"),
        F.avg("avg_temp_uncertainty").alias("avg_temp_uncertainty"),
    )


def dim_temperatures_by_join(temps: DataFrame) -> DataFrame:
    """Same table as two aggregates joined USING city (three exchanges
    instead of one; kept as the USING-join operator)."""
    a = temps.groupBy("city").agg(F.avg("avg_temp").alias("avg_temp"))
    u = temps.groupBy("city").agg(F.avg("avg_temp_uncertainty").alias("avg_temp_uncertainty"))
    return join_using(a, u, ["city"]).select("city", "avg_temp", "avg_temp_uncertainty")
