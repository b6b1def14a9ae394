"""Training-order materialisation of token sequences in fixed-stride shards.

Each input partition's documents make one stream of ids, cut into sequences
of equal length. A first pass counts each partition's sequences, so every
sequence has a global number; a keyed Feistel network, walked along its
cycles until the value is in range, turns numbers into slots, a permutation
of exactly that range. The second pass makes the sequences and sends each
to its shard, a range of slots, where they are written in slot order. Tokens
are moved once and never kept anywhere between: beside the shuffle and the
shards they would take too much disk. Both passes work out each distinct word
of a batch of texts once, the batches being of bounded bytes.

A shard is a file of records of one length, so a reader finds any slot by
multiplication, and resumes where it stopped. A record is ``length`` ids as
little-endian 16-bit numbers (32-bit ones for larger vocabularies) and as many
line feeds as a number has bytes, so a shard maps as an array of ``length + 1``
aligned numbers a row, of which the last is no id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.common import small_batches, text_or_empty
from portolan.llm.tokens import byte_bpe

LENGTH = 1024
END_ID = 50256  # after each document, and after the last one of a partition up to the sequence's end
SHARD_RECORDS = 16_384
BATCH_BYTES = 4 << 20  # of texts in a batch, about: larger ones repeat more of their words, but tasks hold them
_ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit finaliser (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of ``range(size)``, or its inverse. The network
    permutes the next power of four; values out of range go through again."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> shift, out[todo] & mask
        for turn in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            own = key * 1_000_003 + turn
            if back:
                left, right = right ^ (_mix(left, own) & mask), left
            else:
                left, right = right, left ^ (_mix(right, own) & mask)
        out[todo] = (left << shift) | right
        todo = out >= size
    return out.astype(np.int64)


def _streams(length: int, end_id: int, vocabulary: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Ids of a partition as arrays of whole sequences, the last one padded."""
    encoder = byte_bpe(vocabulary)
    rest = np.empty(0, "u4")
    for batch in batches:
        for ids in encoder.stream(batch.column(0).to_pylist(), end_id):
            rest = np.concatenate([rest, ids])
            whole = len(rest) // length * length
            if whole:
                yield rest[:whole].reshape(-1, length)
                rest = rest[whole:]
    if len(rest):
        yield np.pad(rest, (0, length - len(rest)), constant_values=end_id).reshape(-1, length)


def count_sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None,
                    text: str = "text") -> dict[int, int]:
    """Sequences of each input partition, each document with one id after it;
    one number for each partition."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ids = byte_bpe(vocabulary), 0
        for batch in batches:
            ids += encoder.stream_length(batch.column(0).to_pylist())
        n = -(-ids // length)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([n])], names=["part", "n"])

    body = docs.select(text_or_empty(text).alias("text"))
    return {r["part"]: r["n"] for r in body.mapInArrow(work, "part long, n long").collect()}


def write_sequences(docs: DataFrame, path: str, key: int = 1, length: int = LENGTH, end_id: int = END_ID,
                    vocabulary: str | None = None, shard_records: int = SHARD_RECORDS, id_bytes: int = 2,
                    text: str = "text") -> int:
    """Write all sequences of ``docs`` below ``path`` as
    ``shard=<n>/part-*``, one file for each shard, and return how many.

    ``docs`` must come in the same partitions whenever it is computed: a scan
    of files, a checkpoint, or narrow steps on them. A partition whose count
    differs between the passes fails the job. Null text counts as empty and
    gives the end id alone; document ids and other columns are not read, so
    repeated rows are written as often as they occur. An empty table writes
    no shard. Folders that exist already are overwritten.
    """
    with small_batches(docs.sparkSession, BATCH_BYTES):
        counts = count_sequences(docs, length, vocabulary, text)
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part] = total
        total += counts[part]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at = starts.get(part, 0)
        for ids in _streams(length, end_id, vocabulary, batches):
            if int(ids.max()) >> (8 * id_bytes):
                raise ValueError("an id needs more bytes than a record has for it")
            slots = permute(np.arange(at, at + len(ids)), total, key)
            at += len(ids)
            for lo in range(0, len(ids), 1024):
                records = [row.tobytes() for row in ids[lo:lo + 1024].astype(f"<u{id_bytes}")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[lo:lo + 1024]), pa.array(records, pa.binary())], names=["slot", "record"])
        if at != starts.get(part, 0) + counts.get(part, 0):
            raise RuntimeError("a partition changed between counting and writing its sequences")

    shards = max(1, -(-total // shard_records))
    rows = docs.select(text_or_empty(text).alias("text")).mapInArrow(work, "slot long, record binary")
    rows = rows.withColumn("shard", F.expr(f"slot DIV {shard_records}"))
    # A shard is a range of slots known beforehand, so its number is its task's,
    # one task a shard; sampling for ranges would read the texts once more.
    # Spark's text writer puts a string's bytes out as they are, and then the separator.
    with small_batches(docs.sparkSession, BATCH_BYTES):
        (rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")
         .select("shard", F.col("record").cast("string").alias("value"))
         .write.partitionBy("shard").mode("overwrite").text(path, lineSep="\n" * id_bytes))
    return total


def read_sequences(spark: SparkSession, path: str, total: int, key: int = 1, length: int = LENGTH,
                   shard_records: int = SHARD_RECORDS, id_bytes: int = 2, from_slot: int = 0) -> DataFrame:
    """``shard, slot, sequence, byte_offset, record`` of what
    ``write_sequences`` wrote, from a slot on: only shards from its own on
    are opened. ``sequence`` is the number before the permutation."""
    stride = (length + 1) * id_bytes
    names = "shard long, slot long, sequence long, byte_offset long, record binary"
    if not total:
        return spark.createDataFrame([], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                if len(data) % stride:
                    raise ValueError(f"shard {shard} holds a part of a record")
                for at in range(0, len(data) // stride, 1024):
                    n = np.arange(at, min(at + 1024, len(data) // stride))
                    slots = shard * shard_records + n
                    records = [bytes(data[i * stride:(i + 1) * stride - id_bytes]) for i in n.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), shard)), pa.array(slots),
                         pa.array(permute(slots, total, key, back=True)), pa.array(n * stride), pa.array(records, pa.binary())],
                        names=["shard", "slot", "sequence", "byte_offset", "record"])

    files = spark.read.format("binaryFile").load(path).where(F.col("shard") >= from_slot // shard_records)
    # A task holds one shard at a time.
    return files.select(F.col("shard").cast("long"), "content").mapInArrow(work, names).where(F.col("slot") >= from_slot)
