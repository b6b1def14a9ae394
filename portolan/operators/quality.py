"""Data-quality checks over the loaded tables.

Each check returns a small frame (table_name, check_name, key_column,
observed, passed), one row per table; all tables are checked in one job.
``raise_on_failure`` turns failed rows into an exception.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.schemas import STAR_TABLES

DEFAULT_KEYS = {name: key for name, (_, key) in STAR_TABLES.items()}


def _report(tables: dict[str, DataFrame], check: str, keys: dict[str, str] | None,
            observed, passed) -> DataFrame:
    rows = []
    for name, df in tables.items():
        key = (keys or DEFAULT_KEYS).get(name) if check != "row_count" else None
        agg = df.agg(observed(df, key).cast("bigint").alias("observed"))
        rows.append(agg.select(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),
                               F.lit(key).cast("string").alias("key_column"), "observed"))
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("passed", passed(F.col("observed")))


def row_count_check(tables: dict[str, DataFrame]) -> DataFrame:
    """PASS when a table is not empty."""
    return _report(tables, "row_count", None, lambda df, k: F.count(F.lit(1)),
                   lambda o: o > 0)


def null_key_check(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """PASS when no row has a null key."""
    return _report(tables, "null_key", keys, lambda df, k: F.count_if(F.col(k).isNull()),
                   lambda o: o == 0)


def unique_key_check(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """PASS when the declared key is unique: rows - distinct non-null keys = 0."""
    return _report(tables, "unique_key", keys,
                   lambda df, k: F.count(F.lit(1)) - F.count_distinct(F.col(k)),
                   lambda o: o == 0)


def quality_report(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """All three checks for all tables, one aggregation (one pass) per table.

    Row count, null keys and distinct keys are computed together and then
    unpivoted into the report rows, instead of one pass per check.
    """
    keys = keys or DEFAULT_KEYS
    parts = []
    for name, df in tables.items():
        k = F.col(keys[name])
        agg = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(k.isNull()).alias("nulls"),
                     F.count_distinct(k).alias("distinct"))
        rows, nulls, distinct = F.col("rows"), F.col("nulls"), F.col("distinct")
        parts.append(agg.select(F.lit(name).alias("table_name"), F.inline(F.array(
            _check_row("row_count", None, rows, rows > 0),
            _check_row("null_key", keys[name], nulls, nulls == 0),
            _check_row("unique_key", keys[name], rows - distinct, rows == distinct)))))
    return reduce(DataFrame.unionByName, parts)


def _check_row(check: str, key: str | None, observed, passed):
    return F.struct(F.lit(check).alias("check_name"), F.lit(key).cast("string").alias("key_column"),
                    observed.cast("bigint").alias("observed"), passed.alias("passed"))


REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("check_name", T.StringType()),
    T.StructField("key_column", T.StringType()), T.StructField("observed", T.LongType()),
    T.StructField("passed", T.BooleanType())])


def report_from_metrics(spark: SparkSession, metrics: dict[str, dict],
                        keys: dict[str, str] | None = None) -> DataFrame:
    """The row-count and null-key report from metrics observed while the
    tables were written (``load_star_observed``): one small row per table
    and check, no scan of the tables."""
    keys = keys or DEFAULT_KEYS
    rows = []
    for name, m in metrics.items():
        rows.append((name, "row_count", None, int(m["row_count"]), int(m["row_count"]) > 0))
        rows.append((name, "null_key", keys[name], int(m["null_key"]), int(m["null_key"]) == 0))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def raise_on_failure(report: DataFrame) -> DataFrame:
    """Raise if any check failed (the report has one row per table and check)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table_name}.{r.check_name}: observed {r.observed}" for r in failed]
        raise AssertionError("data-quality checks failed: " + "; ".join(lines))
    return report
