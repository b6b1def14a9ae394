"""The example queries and the warehouse checks as SQL text, run by Spark SQL.

Users of the star schema ask it in SQL. Here that text is parsed, planned
and run by Spark: a table reference is a ``{name}`` slot filled with a
frame (the lazy star of ``build_star``, or a catalog table read with
``spark.table``), and values are bound as named parameters (``:port``),
never spliced into the text. Column names of a check are bound with
``IDENTIFIER(:key)``.

Where a query joins the fact to a dimension and then groups, the text first
counts the fact per join key (a CTE) and sums the counts after the join.
That gives the same numbers as counting join rows, but only the small
aggregate meets the dimension, so the fact is never shuffled for the join.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from portolan.schemas import STAR_TABLES

# The five example queries over the star tables.
EXAMPLE_QUERIES: dict[str, str] = {
    "young_arrivals": """
SELECT f.immigration_id, f.age, t.day
FROM {fact_immigrations} f
JOIN {dim_time} t ON t.sas_timestamp = f.arrival_date
WHERE f.landing_port = :port AND f.age < :max_age""",
    "oldest": """
SELECT age FROM {fact_immigrations} ORDER BY age DESC NULLS LAST LIMIT 1""",
    "port_types": """
WITH by_port AS (
  SELECT city, landing_port, COUNT(*) AS n
  FROM {fact_immigrations} GROUP BY city, landing_port)
SELECT p.type AS port_type, SUM(b.n) AS total
FROM by_port b
JOIN {dim_ports} p ON p.city = b.city AND p.iata_code = b.landing_port
GROUP BY p.type
ORDER BY total DESC, port_type ASC NULLS LAST""",
    "top_cities": """
SELECT city, COUNT(*) AS count
FROM {fact_immigrations}
GROUP BY city
ORDER BY count DESC, city ASC NULLS LAST
LIMIT :k""",
    "weekday_counts": """
WITH by_day AS (
  SELECT arrival_date, COUNT(*) AS n FROM {fact_immigrations} GROUP BY arrival_date)
SELECT t.weekday AS arrival_day, SUM(b.n) AS count
FROM by_day b
JOIN {dim_time} t ON t.sas_timestamp = b.arrival_date
GROUP BY t.weekday
ORDER BY arrival_day""",
}

# The warehouse checks, one statement and one scan per table. A row count
# passes when the table is not empty, a null-key count when it is zero.
CHECKS = """
SELECT :table_name AS table_name, c.check_name, c.key_column, c.observed, c.passed
FROM (SELECT COUNT(*) AS n, COUNT_IF(IDENTIFIER(:key) IS NULL) AS nulls FROM {table}) t
LATERAL VIEW inline(array(
  struct('row_count' AS check_name, CAST(NULL AS STRING) AS key_column, n AS observed, n > 0 AS passed),
  struct('null_key' AS check_name, :key AS key_column, nulls AS observed, nulls = 0 AS passed))) c"""


def slots(text: str) -> list[str]:
    """Table slots (``{name}``) of a query text, in order of appearance."""
    return [field for _, field, _, _ in string.Formatter().parse(text) if field]


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame],
            **params) -> DataFrame:
    """Run ``text`` with its table slots filled from ``tables`` and
    ``params`` bound as named parameters. Only the tables the text names
    are taken from ``tables`` (a lazy mapping builds nothing else)."""
    frames = {name: tables[name] for name in dict.fromkeys(slots(text))}
    return spark.sql(text, args=params or None, **frames)


def example_query(spark: SparkSession, name: str, tables: Mapping[str, DataFrame],
                  **params) -> DataFrame:
    """One of the example queries by name, e.g.
    ``example_query(spark, "top_cities", star, k=5)``."""
    return run_sql(spark, EXAMPLE_QUERIES[name], tables, **params)


def warehouse_checks(spark: SparkSession, tables: Mapping[str, DataFrame],
                     keys: Mapping[str, str] | None = None) -> DataFrame:
    """(table_name, check_name, key_column, observed, passed) for every
    check and table, as one frame (one job, one scan per table)."""
    keys = keys or {name: key for name, (_, key) in STAR_TABLES.items()}
    parts = [spark.sql(CHECKS, args={"table_name": name, "key": keys[name]}, table=tables[name]) for name in tables]
    return reduce(DataFrame.unionByName, parts)
