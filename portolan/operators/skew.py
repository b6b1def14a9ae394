"""Heavy hitters: values that hold a given share of the rows, exactly.

A skew view asks which values of wide columns (ports, origins, airlines) hold
so many rows that a shuffle on them would make one task slow. Counting every
value of every column shuffles them all. Here each month's rows go once into
a frequent-items sketch a column (``sketch_months``: bounded state, merged
from task to task), which may be stored and merged with those of other months
later. The merged sketches name all values that can hold the share
(``candidates``), and only those few are counted exactly (``heavy_hitters``).

A sketch with a map of ``m`` entries over ``n`` rows misjudges a count by at
most ``3.5 n / m``, merged ones too, and names each value beyond twice that.
``sketch_months`` tracks ``8 / share`` values, which makes ``m`` at least
``10.6 / share``, so that every value with ``share`` of the rows is named;
at most ``2 / share`` can look that large. Nulls count as a value. No rows,
no values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import maybe_broadcast

SHARE = 0.02


def _check(share: float) -> None:
    if not 0.0001 <= share <= 1:
        raise ValueError(f"the share must be from 0.0001 to 1, not {share}")


def sketch_months(df: DataFrame, month: Column, cols: list[str], share: float = SHARE) -> DataFrame:
    """``month, column_name, n_rows, sketch``: a row for each month and
    column. Values go in as text, so all columns' sketches are alike."""
    _check(share)
    tracked = math.ceil(8 / share)
    named = df.select(month.alias("month"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(cols)])
    sketches = named.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"approx_top_k_accumulate(v{i}, {tracked})").alias(f"s{i}") for i in range(len(cols))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), F.col(f"s{i}").alias("sketch"))
                     for i, c in enumerate(cols)])
    return sketches.select("month", F.inline(rows))


def candidates(sketches: DataFrame, share: float = SHARE) -> DataFrame:
    """``column_name, n_rows, value``: each value that may hold ``share`` of
    all months' rows, none of those that do left out."""
    _check(share)
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.expr("approx_top_k_combine(sketch)").alias("sketch"))
    named = F.expr(f"approx_top_k_estimate(sketch, {math.ceil(2 / share)})")
    return merged.select("column_name", "n_rows", F.explode(named).alias("found")).select(
        "column_name", "n_rows", F.col("found.item").alias("value"))


def heavy_hitters(df: DataFrame, sketches: DataFrame, cols: list[str], share: float = SHARE) -> DataFrame:
    """``column_name, value, count, n_rows``: every value with at least
    ``share`` of the rows of ``df``, whose months ``sketches`` are of. The
    counts are exact: rows are looked up among the few values named, and
    only what is found goes on to be counted."""
    named = maybe_broadcast(candidates(sketches, share))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    rows = df.select(F.inline(pairs))
    same = (rows["column_name"] == named["column_name"]) & rows["value"].eqNullSafe(named["value"])
    counted = rows.join(named, same).groupBy(named["column_name"], named["value"], "n_rows").agg(F.count(F.lit(1)).alias("count"))
    return counted.filter(F.col("count") / F.col("n_rows") >= share).select("column_name", "value", "count", "n_rows")
