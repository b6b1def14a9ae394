"""Helpers shared by the operators: reading, lineage cuts, id buckets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.session import scratch_dir

COARSE, FINE = 1000, 1000  # ranges of a column, and of each of them, at most
ACCURACY = 20 * COARSE  # of a quantile sketch
BATCH_BYTES = 2 << 20  # of rows that go to Python at a time, about


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, so
    that a lost executor costs no more than the rows it held."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """For jobs that run inside: rows go to Python in Arrow batches of about
    ``most`` bytes (one row more at most), whatever the length of their texts.

    Spark's own bound is 10,000 rows, and a task holds its batch several
    times beside the heap: as vectors, as the written stream, and in Python.
    A bound given at launch wins. Frames that run later have Spark's again."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().contains(key):
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sizes
    to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _quantiles(column: str, parts: int) -> Column:
    """The quantiles that split an integer column into ``parts``, ascending;
    a sketch of fixed accuracy, whatever the number of rows and parts."""
    return F.percentile_approx(column, [i / parts for i in range(1, parts)], ACCURACY)


def with_ranges(df: DataFrame, column: str, out: str, ranges: int) -> DataFrame:
    """Add ``out``: the row's range of an integer column, from 0, of about
    ``ranges`` with like numbers of rows, ascending with the column.

    At most ``COARSE`` quantiles of the whole column go through the driver.
    Where more ranges are asked for, each of those is split again by
    quantiles of its own, found by a grouped aggregation; they are joined
    from a broadcast table of at most ``COARSE`` rows of ``FINE`` numbers
    (8 MB). So no sketch and no expression grows with the number of ranges,
    and there are never more than ``COARSE * FINE``. Nulls are in range 0; an
    empty table gives no rows.
    """
    if ranges < 2:
        return df.withColumn(out, F.lit(0))
    cuts = df.agg(_quantiles(column, min(ranges, COARSE)).alias("q")).first()["q"]
    cuts = sorted(set(cuts or []))
    dealt = df.withColumn(out, _place(F.col(column), F.lit(cuts), len(cuts)) if cuts else F.lit(0))
    fine = min(FINE, -(-ranges // COARSE))
    if fine < 2:
        return dealt
    of, bounds = fresh(dealt, "range_of"), fresh(dealt, "range_bounds")
    inner = cut(dealt.groupBy(F.col(out).alias(of)).agg(F.array_distinct(_quantiles(column, fine)).alias(bounds)))
    within = _place(F.col(column), F.col(bounds), fine - 1)
    return (dealt.join(F.broadcast(inner), F.col(out) == F.col(of), "left")
            .withColumn(out, F.col(out) * fine + within).drop(of, bounds))


def _place(column: Column, bounds: Column, most: int) -> Column:
    """How many of the ascending bounds, ``most`` or fewer, are at or below
    the value: a binary search as an expression. Null goes to 0."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]

    # Value and bounds travel in the state: an outer column inside the lambda
    # would be lost from Catalyst's list of this expression's columns.
    def state(at: Column, s: Column) -> Column:
        return F.struct(at.alias("at"), s["value"].alias("value"), s["bounds"].alias("bounds"))

    start = F.struct(F.lit(0).alias("at"), column.alias("value"), bounds.alias("bounds"))
    return F.aggregate(
        F.lit(steps), start,
        lambda s, step: state(F.when(F.get(s["bounds"], s["at"] + step - 1) <= s["value"], s["at"] + step)
                              .otherwise(s["at"]), s),
        lambda s: s["at"])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
