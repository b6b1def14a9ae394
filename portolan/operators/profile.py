"""Column profiling: missing values and value distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.nulls import is_missing


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: per column the number of null (or NaN, for floats) values."""
    names = cols if cols is not None else df.columns
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in names])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col``, most frequent first, equal counts by value.

    Partial aggregation runs before the shuffle, so a value holding a large
    share of the rows costs one row per task, not a hot partition.
    """
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last(col)))


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long-form value counts of several columns in one pass.

    (column_name, value as text, count) for every column in ``cols``: one
    scan and one aggregation instead of one job per column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in cols])
    exploded = df.select(F.inline(pairs))
    return exploded.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """``n`` rows: the first in the order given (a top-n per partition, then
    one merge), or any."""
    return (df.orderBy(*[F.asc_nulls_last(c) for c in order_by]) if order_by else df).limit(n)
