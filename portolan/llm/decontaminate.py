"""Benchmark decontamination by a prefix-filtered join, in SQL functions only.

A benchmark item is cut into windows of ten words (a shorter item is one
window), a window into its shingles of three. A document can hold a window
only if it holds each of the window's shingles, so one shingle of each will
do for the join: the rarest in the documents, which are counted first. Where
a document holds it, its place in the window gives the place of the whole
window, which must lie within the document; there the words are compared.

Documents aren't shuffled: their shingles are tested against a bitmap of the
wanted ones in their own rows, and only those that pass, a few, go on with
the words around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import cut, text_or_empty
from portolan.operators.joins import maybe_broadcast

WINDOW, SHINGLE = 10, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LEAST_BITS, _MOST_BITS = 10, 22  # of a bitmap: 128 bytes to 512 KB
_BITS_EACH = 16  # places in the bitmap for each shingle


def words(text: Column) -> Column:
    """The words in order: ``A-Z`` in lower case, runs of digits, ``a-z`` and
    characters beyond ASCII."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _NO_WORD), "")


def _hash(words: Column, at: Column, size: int) -> Column:
    """The shingle of ``size`` words at a position."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def item_windows(items: DataFrame, id_column: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``window, item_id``, distinct: each window's words with a space
    between, and the items that have it. Items without words have none; a
    null id is the empty string."""
    cutup = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"),
                         words(text_or_empty(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return cutup.select("item_id", F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, window), " "))
                                             ).alias("window")).distinct()


def _shingles(windows: DataFrame, size: int) -> DataFrame:
    """``window, words, at, size, h`` for each shingle of each window; a
    window of fewer words is one shingle."""
    cutup = windows.select("window", F.split("window", " ").alias("words"))
    sizes = F.least(F.size("words"), F.lit(size))
    at = cutup.select("window", "words", sizes.alias("size"), F.explode(
        F.sequence(F.lit(0), F.size("words") - sizes)).alias("at"))
    h = F.coalesce(*[F.when(F.col("size") == k, _hash(F.col("words"), F.col("at"), k)) for k in range(1, size + 1)])
    return at.withColumn("h", h)


def _bitmap(hashes: DataFrame, bits: int) -> Column:
    """The places of the hashes in a bitmap of ``2^bits`` bits, as a literal
    of 64-bit words; its size depends on ``bits`` alone."""
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    set_words = (hashes.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, int(h & {(1 << min(bits, 6)) - 1}))").alias("bit"))
                 .groupBy("word").agg(F.bit_or("bit").alias("bit")).collect())
    of = {r["word"]: r["bit"] for r in set_words}
    text = ",".join(str(of.get(i, 0)) for i in range(1 << (bits - 6)))
    return F.split(F.lit(text), ",").cast("array<long>")


def _occurrences(docs: DataFrame, hashes: DataFrame, sizes: list[int], around: int) -> DataFrame:
    """``id, text_hash, n, pos, size, h`` of the documents' shingles that may
    be among ``hashes``: all that are, and a few others. With ``around``,
    ``near`` is the words from ``around - 1`` before to as many after the
    first one, ``near_from`` the first one's number."""
    found = hashes.count()
    bits = min(max((_BITS_EACH * found).bit_length(), _LEAST_BITS), _MOST_BITS)
    bitmap = _bitmap(hashes, bits)

    def set_in(h: Column) -> Column:
        slot = h.bitwiseAND(F.lit((1 << bits) - 1))
        return F.getbit(F.get(bitmap, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    # The hashes are a column of their own, used more than once, so that they
    # aren't worked out anew in the lambdas that look at them.
    def hashes_of(k: int) -> Column:
        return F.transform("words", lambda _, i: _hash(F.col("words"), i, k)).alias(f"h{k}")

    hashed = docs.select("id", "text_hash", "words", F.size("words").alias("n"), *map(hashes_of, sizes))

    def of_size(k: int) -> Column:
        h = F.col(f"h{k}")
        every = F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0)))
        places = F.when(F.size(h) >= k, F.filter(every, lambda i: set_in(F.get(h, i)))).otherwise(F.array().cast("array<int>"))
        begin = lambda i: F.greatest(i - (around - 1), F.lit(0))
        near = lambda i: [begin(i).alias("near_from"),
                          F.slice("words", begin(i) + 1, 2 * around - 1).alias("near")] if around else []
        return F.transform(places, lambda i: F.struct(i.alias("pos"), F.lit(k).alias("size"), F.get(h, i).alias("h"), *near(i)))

    kept = hashed.select("id", "text_hash", "n", F.concat(*[of_size(k) for k in sizes]).alias("kept"))
    # An inner explode would bring a filter on its array's size, which Catalyst
    # moves down to the scan and there works the whole array out once more,
    # the words anew for each of them.
    rows = kept.select("id", "text_hash", "n", F.explode_outer("kept").alias("s")).where("s IS NOT NULL")
    return rows.select("id", "text_hash", "n", "s.*")


def contaminated_words(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_words, spans, item_ids`` for every row of ``docs``: the
    stretches of words, ``start`` and ``end`` (exclusive), that windows of the
    items occur in, merged where they touch, and the items that these windows
    come from, sorted as strings.

    Words are those of ``words()``; null texts have none and are clean. An
    item without words occurs nowhere. Rows that repeat both id and text are
    marked alike; null ids are an id like any other, as are null item ids,
    read as the empty string. Without items every document is clean; an
    empty table gives no rows. Other columns are not read.
    """
    owners = cut(item_windows(items, item_id, item_text, window))
    parts = cut(_shingles(owners.select("window").distinct(), shingle))
    sizes = sorted(r["size"] for r in parts.select("size").distinct().collect())  # at most ``shingle``
    body = text_or_empty(text)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    # The number of words needs no lower case.
    every = rows.select("doc_id", "text_hash", F.size(F.array_remove(F.split(
        "body", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")).cast("long").alias("n_words"))
    none = [F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("item_ids")]
    if not sizes:
        return every.select("doc_id", "n_words", *none)
    texts = rows.select(F.col("doc_id").alias("id"), "text_hash", words(F.col("body")).alias("words"))
    wanted = cut(parts.groupBy("h").agg(F.count(F.lit(1)).alias("windows")))
    often = (_occurrences(texts, wanted, sizes, 0).join(maybe_broadcast(wanted.select("h")), "h")
             .groupBy("h").agg(F.count(F.lit(1)).alias("often")))
    # Windows whose rarest shingle is nowhere are left out by the inner join
    # of all their shingles' counts.
    ranked = parts.join(wanted, "h").join(often, "h", "left")
    prefix = cut(ranked.groupBy("window", "words").agg(F.min(F.struct(
        F.coalesce("often", F.lit(0)).alias("often"), "windows", "h", "at", "size")).alias("rarest"))
        .where("rarest.often > 0").select("window", F.col("words").alias("wanted"), "rarest.h", "rarest.at", "rarest.size"))
    held = _occurrences(texts, prefix.select("h").distinct(), sizes, window)
    start, long = F.col("pos") - F.col("at"), F.size("wanted")
    fits = (start >= 0) & (start + long <= F.col("n"))
    there = F.slice("near", start - F.col("near_from") + 1, long) == F.col("wanted")
    found = cut(held.join(maybe_broadcast(prefix), ["h", "size"]).where(fits).where(there)
                .select("id", "text_hash", start.alias("start"), (start + long).alias("end"), "window"))
    # Each word that is hit, once; stretches are where the numbers have gaps.
    marks = found.groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("hits")).select(
        F.col("id").alias("own"), F.col("text_hash").alias("own_hash"), F.array_sort(F.array_distinct(F.flatten(
            F.transform("hits", lambda s: F.sequence(s["start"], s["end"] - 1))))).alias("hit"))
    hit = F.col("hit")
    marks = marks.select("own", "own_hash", F.filter(hit, lambda x, i: (i == 0) | (F.get(hit, i - 1) != x - 1)).alias("starts"),
                         F.filter(hit, lambda x, i: (i == F.size(hit) - 1) | (F.get(hit, i + 1) != x + 1)).alias("ends"))
    marks = marks.select("own", "own_hash", F.zip_with("starts", "ends", lambda a, b: F.struct(
        a.alias("start"), (b + 1).alias("end"))).alias("spans"))
    owned = (found.select("id", "text_hash", "window").distinct().join(owners, "window")
             .groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
             .select(F.col("id").alias("its"), F.col("text_hash").alias("its_hash"), "item_ids"))
    both = marks.join(owned, F.col("own").eqNullSafe(F.col("its")) & (F.col("own_hash") == F.col("its_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("text_hash") == F.col("own_hash"))
    return every.join(both, same, "left").select(
        "doc_id", "n_words", *[F.coalesce(name, empty).alias(name) for name, empty in zip(("spans", "item_ids"), none, strict=True)])
