"""Line dedup by overlapping windows of three lines, in SQL functions only.

Every three consecutive lines that aren't blank make a window. The first
occurrence of a window, by document id and line, stays; the lines that later
occurrences cover are merged and removed. Windows are hashed to 128 bits and
counted globally; only hashes move, with counts combined in each task first,
and each text once, to be joined with the lines it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import fresh, text_or_empty

WINDOW = 3


def later_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, gone``: for each document that loses lines, their
    numbers from 0, ascending."""
    body = text_or_empty(text)
    full = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(body).alias("text_hash"),
                       F.split(body, "\n", -1).alias("lines"))
    marked = full.select("doc_id", "text_hash", F.filter(F.transform("lines", lambda x, i: F.struct(
        i.alias("at"), F.trim(x).alias("line"))), lambda s: s["line"] != "").alias("full"))
    hashed = marked.select("doc_id", "text_hash", F.transform("full", lambda s: F.struct(
        s["at"].alias("at"), F.xxhash64(s["line"]).alias("a"), F.xxhash64(F.lit(size), s["line"]).alias("b"))).alias("full"))
    near = [lambda i, k=k: F.get(F.col("full"), i + k) for k in range(size)]
    windows = hashed.where(F.size("full") >= size).select("doc_id", "text_hash", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("full") - size), lambda i: F.struct(
            near[0](i)["at"].alias("first"), near[-1](i)["at"].alias("last"),
            F.xxhash64(*[n(i)["a"] for n in near]).alias("a"),
            F.xxhash64(*[n(i)["b"] for n in near]).alias("b")))).alias("w")).select(
        "doc_id", "text_hash", "w.first", "w.last", "w.a", "w.b")
    place = F.struct("doc_id", "text_hash", "first")
    repeated = (windows.groupBy("a", "b").agg(F.min(place).alias("kept"), F.max(place).alias("latest"))
                .where("latest > kept").select("a", "b", "kept"))
    later = windows.join(repeated, ["a", "b"]).where(place > F.col("kept"))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(
        F.sequence("first", "last"))))).alias("gone"))


def drop_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and the columns
    ``n_lines`` (before) and ``n_removed``.

    Lines are what line feeds part; they are compared without surrounding
    spaces, and blank ones belong to no window, but go with the lines around
    them. A null text stays null with no lines. Documents come in the order
    of id (null first), then of the text's hash; rows that repeat both are
    one document and change alike. An empty table gives no rows. If the
    columns to add exist already, the new ones end in an underscore.
    """
    gone = later_lines(docs, id_column, text, size)
    names = {c: fresh(docs, c) for c in ("text_hash", "own_hash", "lines", "gone", "own", "own_from", "own_to",
                                           "n_lines", "n_removed")}
    h, own_h, lines, lost, own, from_, to = list(names.values())[:7]
    body = text_or_empty(text)
    right = gone.select(F.col("doc_id").alias(own), F.col("text_hash").alias(h), F.col("gone").alias(lost))
    left = docs.withColumn(own_h, F.xxhash64(body))
    same = F.col(id_column).eqNullSafe(F.col(own)) & (F.col(own_h) == F.col(h))
    both = left.join(right, same, "left").withColumn(lines, F.split(body, "\n", -1))
    p, n = F.col(lost), F.size(F.col(lines))
    both = (both.withColumn(from_, F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1)))
            .withColumn(to, F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))))
    starts, ends = F.col(from_), F.col(to)

    def between(j: Column) -> Column:
        """The lines before the j-th removed stretch and after the one before."""
        begin = F.coalesce(F.get(ends, j - 1) + 1, F.lit(0))
        return F.slice(F.col(lines), begin + 1, F.coalesce(F.get(starts, j), n) - begin)

    rebuilt = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(starts)), between)), "\n")
    return both.withColumns({
        text: F.when(p.isNull(), F.col(text)).otherwise(rebuilt),
        names["n_lines"]: F.when(F.col(text).isNull(), F.lit(0)).otherwise(n),
        names["n_removed"]: F.coalesce(F.size(p), F.lit(0)),
    }).drop(h, own_h, lines, lost, own, from_, to)
