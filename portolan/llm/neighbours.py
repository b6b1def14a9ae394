"""Each row's successor in the order of an id, over the whole table.

Rows go to ranges of the id (quantiles, so that they are even). Each range
also gets a copy of the first row of the range after it, so that a window
within the range finds every successor. Rows move once; there is no global
sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, shuffle_partitions, with_ranges


def with_next(rows: DataFrame, id_column: str, tie: str, carried: dict[str, str],
              prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add the successor's columns, descending id; after the last row comes
    the first. ``carried`` maps a column to the name under which the
    successor's value is added. ``tie`` is a long that orders rows with equal
    ids; null ids come last. A table of one row follows itself. ``prepare``
    adds columns to the dealt rows before their successors are looked up.
    Other columns of ``rows`` stay, whatever their names.
    """
    range_, copy, head, of, head_id, head_tie, to = (fresh(rows, c) for c in (
        "_range", "_copy", "_head", "_of", "_head_id", "_head_tie", "_to"))
    dealt = with_ranges(rows, id_column, range_, 2 * shuffle_partitions(rows.sparkSession))
    key = F.struct(F.coalesce(id_column, F.lit(-(1 << 63))).alias("id"), F.col(tie).alias("tie"))
    # One first row for each range, at most 1,000,000 of 32 bytes; its own range
    # comes before it in descending order, so it is copied to the next used one.
    heads = cut(dealt.groupBy(range_).agg(F.max(key).alias(head)))
    whole = Window.orderBy(range_)
    heads = heads.select(
        F.col(range_).alias(of), F.col(head)["id"].alias(head_id), F.col(head)["tie"].alias(head_tie),
        F.coalesce(F.lead(range_).over(whole), F.min(range_).over(Window.partitionBy())).alias(to))
    same = ((F.col(range_) == F.col(of)) & (F.col(head_tie) == F.col(tie))
            & (F.coalesce(id_column, F.lit(-(1 << 63))) == F.col(head_id)))
    copies = (dealt.join(F.broadcast(heads), same).dropDuplicates([of])
              .select(*rows.columns, F.col(to).alias(range_), F.lit(True).alias(copy)))
    order = Window.partitionBy(range_).orderBy(copy, F.col(id_column).desc_nulls_last(), F.col(tie).desc())
    both = prepare(dealt.withColumn(copy, F.lit(False)).unionByName(copies))
    return (both.withColumns({new: F.lead(c).over(order) for c, new in carried.items()})
            .where(~F.col(copy)).drop(range_, copy))
