"""Null and NaN tests that stay pushable to the Parquet scan.

``df.na.drop()`` drops null and NaN but is planned as an
``AtLeastNNonNulls`` filter that is not pushed to the reader; an explicit
``IS NOT NULL`` conjunction (plus ``NOT isnan`` on float columns) gives the
same rows and shows up in ``PushedFilters``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for float columns (isnan is never applied to text)."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, _FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def complete_rows(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Predicate true when none of ``cols`` (default: all) is null or NaN."""
    names = cols if cols is not None else df.columns
    preds = []
    for name in names:
        c = F.col(f"`{name}`")
        p = c.isNotNull()
        if isinstance(df.schema[name].dataType, _FLOATS):
            p = p & ~F.isnan(c)
        preds.append(p)
    return reduce(lambda a, b: a & b, preds, F.lit(True))
