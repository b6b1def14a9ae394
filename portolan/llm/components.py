"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import cut


def roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, longs,
    any direction, repeats and loops allowed): root is the smallest node of
    the component. The number of rounds grows with the logarithm of a
    component's size; a round groups and joins the edges by node and emits no
    more edges than it read, so a hub costs no more than its edges. The
    driver sees a count and a checksum a round.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while (seen := _checksum(now)) != state:
        state = seen
        both = now.union(now.select("b", "a"))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        wide = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the node and its smaller neighbours go to the smallest.
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        down = wide.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(down.union(low.select("a", F.col("m").alias("b"))).distinct())
    tails = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tails.union(tails.select(F.col("root").alias("node"), "root").distinct())


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())
