"""The five analytic queries over the star schema.

Where a query joins the (large) fact to a dimension and then groups, the
fact is first counted per join key. The count is summed after the join,
which gives the same numbers as counting join rows, but only the small
aggregate reaches the join.

``max_rows`` asks for an explicit size check of the dimension before it is
broadcast; leave it unset when the dimension is a lazy frame derived from
the fact (the planner and AQE decide from sizes instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import join_dimension


def young_arrivals(fact: DataFrame, dim_time: DataFrame, port: str, max_age: int = 5,
                   max_rows: int | None = None) -> DataFrame:
    """id, age and day of month of arrivals younger than ``max_age`` at ``port``."""
    young = fact.filter((F.col("age") < max_age) & (F.col("landing_port") == port))
    t = dim_time.select("sas_timestamp", "day")
    j = join_dimension(young, t, young["arrival_date"] == t["sas_timestamp"], "inner", max_rows)
    return j.select("immigration_id", "age", "day")


def oldest(fact: DataFrame) -> DataFrame:
    """Highest age: per-partition top-1, then one merge (no global sort)."""
    return fact.select("age").orderBy(F.desc_nulls_last("age")).limit(1)


def port_types(fact: DataFrame, dim_ports: DataFrame,
               max_rows: int | None = None) -> DataFrame:
    """Arrivals per port type, most first; counts join rows of fact and ports."""
    pre = fact.groupBy("city", "landing_port").agg(F.count(F.lit(1)).alias("n"))
    p = dim_ports.select(F.col("city").alias("p_city"), "iata_code", "type")
    j = join_dimension(pre, p, (pre["city"] == p["p_city"]) & (pre["landing_port"] == p["iata_code"]),
                       "inner", max_rows)
    return (j.groupBy(F.col("type").alias("port_type"))
            .agg(F.sum("n").alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_last("port_type")))


def top_cities(fact: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` cities with most arrivals; equal counts ordered by city."""
    return (fact.groupBy("city").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last("city")).limit(k))


def weekday_counts(fact: DataFrame, dim_time: DataFrame,
                   max_rows: int | None = None) -> DataFrame:
    """Arrivals per weekday (1 = Sunday), counted over fact join dim_time."""
    pre = fact.groupBy("arrival_date").agg(F.count(F.lit(1)).alias("n"))
    t = dim_time.select("sas_timestamp", "weekday")
    j = join_dimension(pre, t, pre["arrival_date"] == t["sas_timestamp"], "inner", max_rows)
    return (j.groupBy(F.col("weekday").alias("arrival_day"))
            .agg(F.sum("n").alias("count"))
            .orderBy("arrival_day"))


def city_populations(fact: DataFrame, cities: DataFrame) -> DataFrame:
    """Arrivals per city beside its records' populations. On tables dealt by
    city, counting and joining both happen within a bucket."""
    counts = fact.groupBy("city").agg(F.count(F.lit(1)).alias("arrivals"))
    return counts.join(cities, "city").select("city", "state", "total_pop", "arrivals")
