"""SimHash near-dedup with pigeonring filtering.

A fingerprint's 64 bits are a ring of ``d + 1`` segments, where ``d`` is the
largest distance of a link. If two fingerprints differ in at most ``d`` bits,
then from some segment on every chain of ``l`` consecutive segments differs
in at most ``l * d / (d + 1)`` bits, that is in at most ``l - 1``. So the
first segment of the chain is equal, the second differs by one bit at most,
and so on: fingerprints are looked up by such chains, one side as it is, the
other with every difference the budgets allow, and the candidates are then
held against the full distance. Within a lookup key the links are reduced to
a forest, so groups of near copies send as many edges as they have members.

A key with too many fingerprints to compare in one task is looked up again
by longer chains; at the full ring a key is one fingerprint, so this ends,
with no pair lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, text_or_empty
from portolan.llm.components import roots
from portolan.operators.joins import maybe_broadcast

SHINGLE, DISTANCE = 3, 3
SEED = 42
FIRST_CHAIN = 2
# Fingerprints of one key that a task compares; keys with more use a longer chain.
GROUP = 16_384
_BLOCK = 1 << 20  # comparisons at a time
_ROWS = "start byte, key long, probe boolean, fp long"


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text: words are runs of other than ASCII white
    space, A-Z lower-cased; each ``shingle`` words (repeats included, all
    words where there are fewer) are hashed by XXH64; a bit is 1 if it is set
    in over half the hashes. Without words, zero."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    width = min(shingle, len(words))
    spans = zip((ends - size)[: len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), ">u8", len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[at:at + 8192])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text: str = "text",
                 hashed: bool = False) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long), and ``text_hash`` if
    ``hashed``. Null text counts as empty."""
    more = [F.xxhash64(text_or_empty(text)).alias("text_hash")] if hashed else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", "text_hash"][:batch.num_columns])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"), *more).mapInArrow(
        work, "doc_id long, fp long" + ", text_hash long" * hashed)


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_column: str = "doc_id",
                text: str = "text", group: int = GROUP, hashed: bool = False) -> DataFrame:
    """``doc_id, fp, component_id``, a row for each row of ``docs``: the
    smallest id that is reachable over links of at most ``distance`` bits;
    ``text_hash`` too if ``hashed``.

    Texts without words share the fingerprint zero and link like any other.
    Repeated rows come back repeated. A null id doesn't count for the
    smallest, so a component of null ids only has a null one. An empty table
    gives no rows. Other columns are not read.
    """
    marked = cut(fingerprints(docs, shingle, id_column, text, hashed))
    each = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    found = roots(links(each.select("fp"), distance, group))
    tree = each.join(found, each["fp"] == found["node"], "left").select(
        "fp", "least", "n", "root", F.coalesce("root", "fp").alias("top"))
    tops = tree.where("root IS NOT NULL").groupBy("top").agg(F.min("least").alias("component_id"))
    grouped = tree.where("root IS NOT NULL OR n > 1").join(tops, "top", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("grouped"))
    return marked.join(grouped, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *["text_hash"] * hashed)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_column: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with its
    columns; all of its rows with that id, and all with none where a component
    has no id. Rows are told apart by id and text, so an id that stands for
    two texts stays or goes with each one's component."""
    names = [fresh(docs, c) for c in ("gone_id", "gone_hash", "own_hash")]
    going = near_groups(docs, shingle, distance, id_column, text, hashed=True).where(
        ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = cut(going.select(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).distinct())
    same = F.col(id_column).eqNullSafe(F.col(names[0])) & (F.col(names[2]) == F.col(names[1]))
    return docs.withColumn(names[2], F.xxhash64(text_or_empty(text))).join(
        maybe_broadcast(gone), same, "left_anti").drop(names[2])


def links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) that
    connect just those which links of at most ``distance`` bits connect."""
    segments = distance + 1
    chain = min(FIRST_CHAIN, segments)
    rows = fps.mapInPandas(_lookups(segments, chain), _ROWS)
    edges = None
    while True:
        hot = None
        if chain < segments:
            hot = cut(rows.where("NOT probe").groupBy("start", "key").count().where(F.col("count") > group)
                      .select("start", "key"))
            if hot.isEmpty():
                hot = None
        cool = rows if hot is None else rows.join(hot, ["start", "key"], "left_anti")
        dealt = cool.repartition("start", "key").sortWithinPartitions("start", "key", "probe", "fp")
        some = dealt.mapInPandas(_forest(distance), "a long, b long")
        edges = some if edges is None else edges.union(some)
        if hot is None:
            return edges
        chain += 1
        rows = rows.join(hot, ["start", "key"], "left_semi").mapInPandas(_longer(segments, chain), _ROWS)


def _bounds(segments: int, start: int, chain: int) -> tuple[int, int, int]:
    """Bits before the chain, in it, and in its last segment."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    sizes = [edges[(start + i) % segments + 1] - edges[(start + i) % segments] for i in range(chain)]
    return edges[start], sum(sizes), sizes[-1]


def _chain_value(fps: np.ndarray, before: int, bits: int) -> np.ndarray:
    """The ``bits`` bits after the first ``before``, round the ring."""
    turned = fps if not before else (fps << np.uint64(before)) | (fps >> np.uint64(64 - before))
    return turned >> np.uint64(64 - bits)


def _flips(bits: int, most: int) -> np.ndarray:
    """Every difference of at most ``most`` bits in a segment."""
    return np.array([sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(range(bits), n)],
                    np.uint64)


def _frame(start: int, key: np.ndarray, probe: bool, fp: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"start": np.full(len(fp), start, np.int8), "key": key.view(np.int64),
                         "probe": np.full(len(fp), probe), "fp": fp.view(np.int64)})


def _variants(fps: np.ndarray, segments: int, start: int, chain: int) -> np.ndarray:
    """Rows of chain differences within the budgets, as an array of masks."""
    masks, used = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    for length in range(1, chain + 1):
        bits = _bounds(segments, start, length)[2]
        flips = _flips(bits, length - 1)
        spent = used[:, None] + np.bitwise_count(flips)[None, :]
        wide = (masks[:, None] << np.uint64(bits)) | flips[None, :]
        within = spent <= length - 1
        masks, used = wide[within], spent[within].astype(np.int64)
    return masks


def _lookups(segments: int, chain: int):
    """Fingerprints -> a row under each own chain, and a probe under each
    chain that the budgets allow."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 4096):
                fps = frame["fp"].to_numpy()[at:at + 4096].view(np.uint64)
                for start in range(segments):
                    before, bits, _ = _bounds(segments, start, chain)
                    own = _chain_value(fps, before, bits)
                    masks = _variants(fps, segments, start, chain)
                    yield _frame(start, own, False, fps)
                    yield _frame(start, (own[:, None] ^ masks[None, :]).ravel(), True, np.repeat(fps, len(masks)))

    return work


def _longer(segments: int, chain: int):
    """Rows of the chain one shorter -> rows of this chain: the next segment
    is added, for probes with every difference that is left of the budget."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (start, probe), part in frame.groupby(["start", "probe"]):
                before, bits, last = _bounds(segments, start, chain)
                key, fps = part["key"].to_numpy().view(np.uint64), part["fp"].to_numpy().view(np.uint64)
                own = _chain_value(fps, before, bits)
                added = own & np.uint64((1 << last) - 1)
                if not probe:
                    yield _frame(start, own, False, fps)
                    continue
                spent = np.bitwise_count(key ^ (own >> np.uint64(last))).astype(np.int64)
                for used in np.unique(spent):
                    flips = _flips(last, chain - 1 - int(used))
                    mine = np.flatnonzero(spent == used)
                    step = max(1, _BLOCK // len(flips))
                    for at in range(0, len(mine), step):
                        rows = mine[at:at + step]
                        keys = (key[rows, None] << np.uint64(last)) | (added[rows, None] ^ flips[None, :])
                        yield _frame(start, keys.ravel(), True, np.repeat(fps[rows], len(flips)))

    return work


def _forest(distance: int):
    """Rows sorted by key, own rows before probes -> edges. Each probe is
    held against the key's own fingerprints that are smaller; it sends one
    edge to a match, and one for each merger of matches that were apart. Holds one key's own fingerprints and a block of probes."""
    def match(own: np.ndarray, labels: np.ndarray, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, _BLOCK // len(own))
        for at in range(0, len(probes), step):
            block = probes[at:at + step]
            near = (np.bitwise_count(block[:, None] ^ own[None, :]) <= distance) & (own[None, :] < block[:, None])
            some = near.any(axis=1)
            if not some.any():
                continue
            block, near = block[some], near[some]
            yield block, own[near.argmax(axis=1)]
            low = np.where(near, labels[None, :], len(own)).min(axis=1)
            high = np.where(near, labels[None, :], -1).max(axis=1)
            for row in np.flatnonzero(low != high):
                hits = np.flatnonzero(near[row])
                apart, firsts = np.unique(labels[hits], return_index=True)
                if len(apart) > 1:
                    yield own[hits[firsts[1:]]], np.repeat(own[hits[firsts[0]]], len(apart) - 1)
                    labels[np.isin(labels, apart)] = apart[0]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, own, labels = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for frame in frames:
            start, keys = frame["start"].to_numpy(), frame["key"].to_numpy()
            probe, fps = frame["probe"].to_numpy(bool), frame["fp"].to_numpy().view(np.uint64)
            edge = np.flatnonzero((start[1:] != start[:-1]) | (keys[1:] != keys[:-1])) + 1
            first = np.concatenate([[0], edge]).astype(np.int64) if len(fps) else np.zeros(0, np.int64)
            last = np.concatenate([edge, [len(fps)]]).astype(np.int64) if len(fps) else first
            owns = np.add.reduceat(~probe, first) if len(fps) else first
            # Groups with something to compare; the first and the last may go
            # on beyond this frame.
            worth = (owns > 0) & (last - first - owns >= 2)
            worth[:1] = worth[-1:] = True
            a, b = [], []
            for g in np.flatnonzero(worth).tolist():
                lo, hi, n = int(first[g]), int(last[g]), int(owns[g])
                if not (g == 0 and key == (start[lo], keys[lo])):
                    key, own = (start[lo], keys[lo]), fps[lo:lo + n]
                    labels = np.arange(n)
                elif n:
                    own = np.concatenate([own, fps[lo:lo + n]])
                    labels = np.arange(len(own))
                if len(own):
                    for p, q in match(own, labels, fps[lo + n:hi]):
                        a.append(p)
                        b.append(q)
            if a:
                yield pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return work
