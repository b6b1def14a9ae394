"""Order MinHash fingerprints, in SQL functions only.

A text is its sequence of words; its k-mers are pairs of neighbouring words,
the last word standing alone, each numbered by how often it has occurred
before. One hash deals the numbered k-mers into ``BINS`` bins (in place of as
many permutations, at a hundredth of the work); in each bin the two smallest
are taken, put back into text order and hashed as a tuple. Since a tuple
keeps the order, moved passages change it as insertions and deletions do: the
share of equal tuples follows the edit distance, not just the set of words.
In a short text most bins have fewer than two k-mers, and a tuple of one has
no order: ``fill`` takes what is missing from the next bins round the ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import fresh

BINS = 64
_BIN_BITS = 6
_MOST = 2 * BINS  # k-mers that are kept of a text
_HASH_BITS = 36  # of which the highest are the bin
_POS_BITS = 27  # positions count modulo this many bits
# Steps for the search of a run's start; they add up to more than any array's length.
_STEPS = [1 << i for i in reversed(range(31))]


def add_fingerprint(df: DataFrame, text: str, out: str, fill: bool = False) -> DataFrame:
    """Add ``out``, an ascending array of longs, one for each bin that has
    k-mers: bin number and 32 bits of its tuple's hash. With ``fill`` every
    bin has one, of the first two k-mers by hash from the bin's start on,
    round the ring: an ordered pair wherever the text has two k-mers.

    Words are runs of other than white space; case counts. A null or empty
    text, and one of white space only, has the empty fingerprint. Equal texts
    have equal fingerprints. Each array is bounded by its own text, and no
    row moves. A column named ``out`` is replaced, the others stay.
    """
    low = (1 << _HASH_BITS) - 1

    def packed(h: Column, pos: Column) -> Column:
        return F.shiftleft(h.bitwiseAND(F.lit(low)), _POS_BITS).bitwiseOR(
            pos.cast("long").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))

    def numbered(x: Column, i: Column, all_: Column) -> Column:
        """The k-mer with its occurrence number: how far the run of equal
        hashes, sorted by position, reaches back, found by halving."""
        h = F.shiftright(x, _POS_BITS)

        def back(by: Column) -> Column:
            return F.shiftright(F.get(all_, i - by), _POS_BITS) == h

        steps = F.filter(F.lit(_STEPS), lambda s: s <= i)
        run = F.aggregate(steps, F.lit(0), lambda d, s: F.when((d + s <= i) & back(d + s), d + s).otherwise(d))
        again = (i > 0) & back(F.lit(1))
        return F.when(again, packed(F.xxhash64(h, run), x)).otherwise(x)

    def in_bin(x: Column) -> Column:
        return F.shiftright(x, _HASH_BITS + _POS_BITS - _BIN_BITS)

    def in_order(x: Column, y: Column) -> Column:
        pos = F.lit((1 << _POS_BITS) - 1)
        a, b = F.shiftright(x, _POS_BITS), F.shiftright(y, _POS_BITS)
        return F.when(x.bitwiseAND(pos) <= y.bitwiseAND(pos), F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))

    w, s, t, m = (fresh(df, f"{out}_{c}") for c in "wstm")
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda x: x != "")
    step = df.withColumn(w, words)
    step = step.withColumn(s, F.sort_array(F.transform(
        w, lambda x, i: packed(F.xxhash64(x, F.get(F.col(w), i + 1)), i))))
    step = step.withColumn(t, F.sort_array(F.transform(s, lambda x, i: numbered(x, i, F.col(s)))))
    # The two smallest of each bin: no row or one row before it in the bin.
    step = step.withColumn(m, F.filter(t, lambda x, i: (i < 2) | (in_bin(F.get(F.col(t), i - 2)) != in_bin(x))))

    if fill:
        many = F.size(m)
        halves = F.lit([1 << i for i in reversed(range(_MOST.bit_length() - 1))])

        def start(b: Column) -> Column:
            """How many k-mers lie in the bins before."""
            return F.aggregate(halves, F.lit(0), lambda d, half: F.when(
                in_bin(F.get(F.col(m), d + half - 1)) < b, d + half).otherwise(d))

        def pair_of(d: Column, b: Column) -> Column:
            x, y = F.get(F.col(m), d % many), F.get(F.col(m), (d + 1) % many)
            joined = F.when(many == 1, F.xxhash64(F.shiftright(x, _POS_BITS))).otherwise(in_order(x, y))
            return F.shiftleft(b.cast("long"), 32).bitwiseOR(joined.bitwiseAND(F.lit(0xFFFFFFFF)))

        bins = F.filter(F.lit(list(range(BINS))), lambda b: many > 0)
        return step.withColumn(out, F.transform(F.transform(bins, start), pair_of)).drop(w, s, t, m)

    def tuple_of(x: Column, i: Column) -> Column:
        after = F.get(F.col(m), i + 1)
        alone = after.isNull() | (in_bin(after) != in_bin(x))
        joined = F.when(alone, F.xxhash64(F.shiftright(x, _POS_BITS))).otherwise(in_order(x, after))
        first = (i == 0) | (in_bin(F.get(F.col(m), i - 1)) != in_bin(x))
        return F.when(first, F.shiftleft(in_bin(x), 32).bitwiseOR(joined.bitwiseAND(F.lit(0xFFFFFFFF))))

    return step.withColumn(out, F.filter(F.transform(m, tuple_of), lambda x: x.isNotNull())).drop(w, s, t, m)


def as_text(fingerprint: str) -> Column:
    """The fingerprint as hexadecimal digits, ten for each bin."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 10, "0")), "")


def likeness(a: str, b: str) -> Column:
    """The share of bins used by either text whose tuples are equal, from 0
    to 1; two empty fingerprints are alike."""
    def bins(c: str) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, 32))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")
