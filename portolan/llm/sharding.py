"""Contiguous shards of near-equal bytes, by global prefix sums.

Rows are dealt into id ranges; each range's total bytes and rows give its
place in the whole, and a running sum within the range gives each row's. The
rows move once, without their texts. No range depends on a hot key: the
ranges are quantiles of the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, shuffle_partitions, text_or_empty, with_ranges

ROW_BYTES = 16


def byte_shards(docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text",
                row_bytes: int = ROW_BYTES) -> DataFrame:
    """Put each row into one of ``shards`` contiguous ranges of the id order.

    Returns ``doc_id, size, text_crc32, shard, slot``: size is the text's
    UTF-8 bytes plus ``row_bytes``; slot counts from 0 in each shard, without
    gaps. A row belongs to the shard whose equal share of all bytes holds the
    row's middle, so a shard's size differs from its share by at most one
    row at each end.

    Null text counts as empty, null ids come first, rows with equal ids
    follow by checksum and size, and rows that are equal throughout are
    interchangeable. An empty table gives no rows. Other columns are not
    read.
    """
    spark = docs.sparkSession
    body = text_or_empty(text)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(body).cast("long") + row_bytes).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"))
    rows = with_ranges(rows, "doc_id", "range", 2 * shuffle_partitions(spark))
    before = (Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    running = cut(rows.select(
        "*", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_before"),
        F.count(F.lit(1)).over(before).alias("rows_before")))
    # One row for each range, at most 1,000,000 of four numbers: safe to sum up
    # in one task and to broadcast.
    totals = running.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("range_bytes"),
        F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("range_rows"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    placed = running.join(F.broadcast(places), "range").select(
        "doc_id", "size", "text_crc32",
        F.expr(f"""CAST(least({shards - 1}, ((2 * (range_bytes + bytes_before) + size) * {shards})
                   DIV (2 * all_bytes)) AS INT)""").alias("shard"),
        (F.col("range_rows") + F.col("rows_before")).alias("row"))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str, id_column: str = "doc_id", text: str = "text") -> None:
    """Write the rows as Parquet folders ``shard=<n>``, each shard's rows in
    slot order in one file. Rows with the same id and text are written as
    often as they occur; a null id is none of the others."""
    placed = byte_shards(docs, shards, id_column, text)
    names = {c: fresh(docs, c) for c in ("doc_id_", "no_id", "size", "text_crc32", "nth", "slot", "shard")}
    key = [names[c] for c in ("doc_id_", "no_id", "size", "text_crc32", "nth")]
    body = text_or_empty(text)
    # Rows equal in id, size and checksum are told apart by a running number.
    given = docs.withColumns({names["doc_id_"]: F.coalesce(F.col(id_column), F.lit(-1)),
                              names["no_id"]: F.col(id_column).isNull(),
                              names["size"]: F.octet_length(body).cast("long") + ROW_BYTES,
                              names["text_crc32"]: F.crc32(body.cast("binary"))})
    given = given.withColumn(key[4], F.row_number().over(Window.partitionBy(*key[:4]).orderBy(F.lit(0))))
    placed = placed.select(F.coalesce("doc_id", F.lit(-1)).alias(key[0]), F.col("doc_id").isNull().alias(key[1]),
                           F.col("size").alias(key[2]), F.col("text_crc32").alias(key[3]),
                           F.col("shard").alias(names["shard"]),
                           F.col("slot").alias(names["slot"]))
    placed = placed.withColumn(key[4], F.row_number().over(
        Window.partitionBy(*key[:4]).orderBy(names["shard"], names["slot"])))
    (given.join(placed, key).drop(*key)
     .repartitionByRange(shards, names["shard"]).sortWithinPartitions(names["shard"], names["slot"])
     .drop(names["slot"]).write.partitionBy(names["shard"]).parquet(path))
