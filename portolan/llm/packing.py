"""Best-fit packing of documents into fixed-length sequences by bin completion.

Tokens are counted in tasks; a document longer than a sequence is cut into
full pieces after a shorter first one. The packing itself needs only how many
pieces there are of each length, a table of at most ``capacity`` rows however
large the corpus, so the search runs over that and returns patterns: so many
sequences, each filled with these lengths. Pieces are numbered within their
length by a distributed rank (in hash buckets, so that a length which most
pieces have is spread), and a rank's pattern gives its sequence and offset.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import cut, shuffle_partitions, text_or_empty
from portolan.llm.tokens import byte_bpe

CAPACITY = 1024
END_ID = 2  # after each document
WIDTH = 12  # fillings tried around the largest piece at first
TRIES = 4000  # lengths that are put into fillings at a step at first
NODES = 1500  # steps of the search; the best packing found so far always holds

Filling = tuple[tuple[int, int], ...]  # (length, how often), longest first


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None,
           id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's pieces:
    the ids of its whole text and ``end_id``, cut into pieces of ``capacity``
    of which the first may be shorter. Null text counts as empty and gives
    one piece that holds ``end_id``."""
    end = end_id.to_bytes(4, "little")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(vocabulary)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(body) + end
                n = len(ids) // 4
                at, to = 0, n % capacity or capacity
                piece = 0
                while at < n:
                    for column, value in zip(out, (doc, piece, at, to - at, zlib.crc32(ids[4 * at:4 * to])), strict=True):
                        column.append(value)
                    at, to, piece = to, to + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        cut_up, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, width: int = WIDTH, nodes: int = NODES) -> DataFrame:
    """Give each piece a sequence and its place there.

    Adds ``sequence_id, offset`` to ``pieces`` (columns ``doc_id, piece,
    length`` and any others): sequences count from 0, and a sequence's pieces
    lie gapless from offset 0 within ``capacity``. Lengths must be from 1 to
    ``capacity``. Repeated rows are packed as often as they occur, and null
    ids like any other. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    pieces = cut(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    places = _places(complete_bins(counts, capacity, width, nodes))
    buckets = shuffle_partitions(spark)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", *[
        c for c in pieces.columns if c not in ("doc_id", "piece", "length")])
    ranked = dealt.withColumn("_own", F.row_number().over(own) - 1)
    upto = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    below = (dealt.groupBy("length", "_bucket").count()
             .select("length", "_bucket", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_below")))
    ranked = ranked.join(below, ["length", "_bucket"]).withColumn("_rank", F.col("_below") + F.col("_own"))
    # A row for each pattern and length in it: the patterns are bounded by
    # the number of lengths and of search steps, not by the corpus.
    table = F.broadcast(spark.createDataFrame(
        places, "_length long, _from long, _to long, _each long, _sequence long, _offset long"))
    hit = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    nth = F.col("_rank") - F.col("_from")
    return ranked.join(table, hit).select(
        *pieces.columns,
        (F.col("_sequence") + F.expr("(_rank - _from) DIV _each")).alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"))


def _places(patterns: list[tuple[int, Filling]]) -> list[tuple[int, int, int, int, int, int]]:
    """length, first and last rank, pieces a sequence, first sequence, offset."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for copies, filling in patterns:
        offset = 0
        for length, each in filling:
            rows.append((length, used[length], used[length] + copies * each, each, sequence, offset))
            used[length] += copies * each
            offset += length * each
        sequence += copies
    return rows


def complete_bins(counts: dict[int, int], capacity: int, width: int = WIDTH, nodes: int = NODES) -> list[tuple[int, Filling]]:
    """Patterns ``(copies, filling)`` that use up ``counts`` (length -> how
    many) in as few bins as the search finds.

    Best fit decreasing gives the first incumbent. Then, depth first: the
    largest length left is completed by undominated fillings, those with the
    least waste first, each applied to as many bins as it can fill, and then
    to one bin fewer; now and then, best fit on the rest gives a new
    incumbent. A branch ends when its waste so far, or that and the least
    waste of the rest, allow no fewer bins than the incumbent. If no branch
    is left and fillings were left out, the search begins again with twice
    the width and tries. It stops at the lower bound or after ``nodes``
    steps.
    """
    counts = {length: n for length, n in counts.items() if n}
    if any(not 1 <= length <= capacity for length in counts):
        raise ValueError("a piece is empty or longer than the capacity")

    def bins(patterns: list[tuple[int, Filling]]) -> int:
        return sum(copies for copies, _ in patterns)

    total = sum(length * n for length, n in counts.items())
    best = best_fit(counts, capacity)
    fewest = bins(best)
    goal = -(-(total + least_waste(counts, capacity)) // capacity)
    # What is left, the filling to apply to it, waste with it, patterns so far.
    root = (counts, None, 0, None)
    stack: list[tuple] = [root]
    tries, left_out = TRIES, False
    for step in range(nodes):
        if fewest <= goal or not (stack or left_out):
            break
        if not stack:
            stack, left_out, width, tries = [root], False, 2 * width, 2 * tries
        rest, branch, waste, done = stack.pop()
        if waste > (fewest - 1) * capacity - total:
            continue
        if branch is not None:
            copies, filling = branch
            rest = dict(rest)
            for length, each in filling:
                rest[length] -= copies * each
                if not rest[length]:
                    del rest[length]
            done = (done, branch)
        if not rest or step % 32 == 31:
            if waste + least_waste(rest, capacity) > (fewest - 1) * capacity - total:
                continue
            filled, chain = best_fit(rest, capacity), done
            while chain is not None:
                chain, one = chain
                filled.append(one)
            if bins(filled) < fewest:
                best, fewest = filled, bins(filled)
        if rest:
            found, whole = _fillings(rest, capacity, width, tries)
            left_out = left_out or not whole
            most = [min(rest[length] // each for length, each in filling) for filling in found]
            branches = [*zip(most, found, strict=True), *((n - 1, f) for n, f in zip(most, found, strict=True) if n > 1)]
            for copies, filling in reversed(branches):
                slack = copies * (capacity - sum(length * each for length, each in filling))
                stack.append((rest, (copies, filling), waste + slack, done))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Filling]]:
    """Best fit decreasing, many equal bins at a time."""
    rooms: list[int] = []  # the distinct rooms left, ascending
    groups: dict[int, list[list]] = {}  # room -> [[bins, filling], ...]

    def put(room: int, n: int, filling: Filling) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append([n, filling])

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                if todo // each:
                    put(capacity - each * length, todo // each, ((length, each),))
                if todo % each:
                    put(capacity - todo % each * length, 1, ((length, todo % each),))
                break
            room = rooms[i]
            group = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            n, filling = group
            each = min(room // length, todo)
            full = min(n, todo // each)
            put(room - each * length, full, (*filling, (length, each)))
            if n > full:
                put(room, n - full, filling)
            todo -= full * each
    return [(n, filling) for room in rooms for n, filling in groups[room]]


def least_waste(counts: dict[int, int], capacity: int) -> int:
    """Room that no packing of ``counts`` can fill: what lies beside lengths
    over half the capacity and is more than all lengths that fit there."""
    waste = carried = 0
    small = sorted(length for length in counts if 2 * length <= capacity)
    at = 0
    for length in sorted((x for x in counts if 2 * x > capacity), reverse=True):
        while at < len(small) and small[at] <= capacity - length:
            carried += small[at] * counts[small[at]]
            at += 1
        room = (capacity - length) * counts[length]
        waste += max(0, room - carried)
        carried = max(0, carried - room)
    return waste


def fillings(counts: dict[int, int], capacity: int, width: int, steps: int = TRIES) -> list[Filling]:
    """Up to ``width`` undominated ways to fill a bin around the largest
    length, least waste first. A filling is dominated if a length left over
    fits into its room, or could take the place of a smaller one or of two
    smaller ones in it. Fillings with the longest lengths are tried first,
    ``steps`` lengths of them at most."""
    return _fillings(counts, capacity, width, steps)[0]


def _fillings(counts: dict[int, int], capacity: int, width: int, steps: int) -> tuple[list[Filling], bool]:
    """``fillings``, and whether these are all there are."""
    ascending = sorted(counts)
    top = ascending[-1]
    found: dict[Filling, int] = {}
    tries, cut_short = steps, False

    def spare(length: int, inside: dict[int, int]) -> bool:
        return counts[length] > inside.get(length, 0)

    def dominated(inside: dict[int, int], room: int) -> bool:
        for length in ascending:
            if length > room:
                break
            if spare(length, inside):
                return True
        parts = [length for length, each in inside.items() for _ in range(min(each, 2)) if length != top or each > 1]
        for i, part in enumerate(parts):
            for low in (part, *(part + other for other in parts[:i])):
                at = bisect_left(ascending, low + (low == part))
                while at < len(ascending) and ascending[at] <= low + room:
                    if spare(ascending[at], inside):
                        return True
                    at += 1
        return False

    def fill(below: int, room: int, inside: dict[int, int]) -> None:
        """Fill the room with lengths among the first ``below``."""
        nonlocal tries, cut_short
        below = min(below, bisect_left(ascending, room + 1))
        if below == 0 or room == 0:
            key = tuple(sorted(inside.items(), reverse=True))
            if key not in found and not dominated(inside, room):
                found[key] = room
            return
        for at in range(below - 1, -1, -1):
            if tries <= 0 or sum(not r for r in found.values()) >= width:
                cut_short = True
                return
            tries -= 1
            length = ascending[at]
            for each in range(min(room // length, counts[length] - inside.get(length, 0)), 0, -1):
                fill(at, room - each * length, {**inside, length: inside.get(length, 0) + each})
        fill(0, room, inside)

    fill(len(ascending), capacity - top, {top: 1})
    if not found:
        # The tries ended first: the longest that fit, one after the other.
        inside, room = {top: 1}, capacity - top
        for length in reversed(ascending):
            each = min(room // length, counts[length] - inside.get(length, 0))
            if each > 0:
                inside[length] = inside.get(length, 0) + each
                room -= each * length
        found[tuple(sorted(inside.items(), reverse=True))] = room
    return sorted(found, key=lambda f: found[f])[:width], not cut_short and len(found) <= width
