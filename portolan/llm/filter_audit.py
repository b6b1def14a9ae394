"""What each of several filters removes, in every order of applying them.

Whether a filter fails a document doesn't depend on the order, so documents
count only by which filters they fail: one grouped aggregation. For every
such mask and order, the step that removes a document is the least position
of a filter that it fails: the min-plus product of the mask matrix (0 where a
filter fails, infinite elsewhere) and the matrix of the filters' positions,
the inverses of the orders. The steps say where each mask's counts are added
up, and which failures come after the removal.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import text_or_empty

# The rules' bounds.
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
SIGNS = "[#$%&*|]"
_SPACE = r"[\x20\x09-\x0D]+"
RULES = "ABCDE"
MOST_FILTERS = 7  # all orders are listed: 5,040 for seven


def fail_rules(docs: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``id, part, digest, fails, copies``: which of the rules A to E each row
    fails, as an array of booleans, rows that agree in all being one.

    A: under 50 words (runs of other than ASCII white space); B: under 65
    distinct words in 100; C: more than 5 in 100 characters are ``A-Z``; D: a
    character of ``#$%&*|``; E: a smaller id has the same text, anywhere in
    the table. A null text counts as empty (it fails A only, and E if
    repeated). A null id is above all others, and null ids among themselves
    are equal; a null part is the empty string.
    """
    body = text_or_empty(text)
    seen = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        body.alias("body"), F.array_remove(F.split(body, _SPACE), "").alias("words"))
    n = F.size("words")
    rows = seen.select(
        "id", "part", F.sha2(F.col("body").cast("binary"), 256).alias("digest"), F.array(
            n < LEAST_WORDS,
            100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT_PERCENT * n.cast("long"),
            100 * F.regexp_count("body", F.lit("[A-Z]")).cast("long") > CAPITALS_PERCENT * F.length("body").cast("long"),
            F.col("body").rlike(SIGNS)).alias("fails")).groupBy(
        "id", "part", "digest", "fails").agg(F.count(F.lit(1)).alias("copies"))
    # The first of each text is found by id and text, keys that are spread
    # even where a third of all rows share one text.
    firsts = rows.groupBy("digest").agg(F.min("id").alias("first")).select(
        F.col("digest").alias("own"), "first", F.lit(False).alias("later"))
    same = (F.col("digest") == F.col("own")) & F.col("id").eqNullSafe(F.col("first"))
    return rows.join(firsts, same, "left").select(
        "id", "part", "digest", F.concat("fails", F.array(F.coalesce("later", F.lit(True)))).alias("fails"), "copies")


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, steps)``: the position, from 1, of each filter in each
    order (orders x filters), and the step at which a document of each mask
    goes in each order (masks x orders; ``filters + 1``: it stays). Bit i of
    a mask is filter i."""
    orders = np.array(list(permutations(range(filters))), int).reshape(-1, filters)
    positions = np.argsort(orders, axis=1) + 1
    fails = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    masks = np.where(fails == 1, 0, filters + 1)
    steps = np.min(np.minimum(masks[:, None, :] + positions[None, :, :], filters + 1), axis=2, initial=filters + 1)
    return positions, steps


def interactions(counts: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """From ``counts`` (masks x weights, the first of them documents), arrays
    over orders and positions: ``kept``, ``removed`` and ``redundant``
    documents, ``lost`` (the other weights of the removed, one more axis);
    and over filters: ``alone`` (failing that filter only) and ``shapley``
    (removed by the filter, summed over all orders)."""
    positions, steps = removal_steps(filters)
    n_orders = len(positions)
    orders = np.arange(n_orders)
    scattered = np.zeros((n_orders, filters + 2, counts.shape[1]), np.int64)
    redundant = np.zeros((n_orders, filters + 2), np.int64)
    alone = np.zeros(filters, np.int64)
    for mask in np.flatnonzero(counts[:, 0]):
        np.add.at(scattered, (orders, steps[mask]), counts[mask])
        failed = [f for f in range(filters) if mask >> f & 1]
        if len(failed) == 1:
            alone[failed[0]] += counts[mask, 0]
        for f in failed:
            after = positions[:, f] > steps[mask]
            np.add.at(redundant, (orders[after], positions[after, f]), counts[mask, 0])
    removed = scattered[:, 1:filters + 1]
    own = np.take_along_axis(removed[:, :, 0], positions - 1, axis=1)  # by filter
    return {"kept": counts[:, 0].sum() - removed[:, :, 0].cumsum(axis=1), "removed": removed[:, :, 0],
            "redundant": redundant[:, 1:filters + 1], "lost": removed[:, :, 1:], "alone": alone, "shapley": own.sum(axis=0)}


def audit(rows: DataFrame, fails: str, part: str, weights: Sequence[Column | str], names: Sequence[str],
          letters: str = RULES) -> DataFrame:
    """``part, filter_order, step`` with ``kept, removed, redundant,
    unique_fails``, the ``names`` (what of each further weight is removed
    there) and ``shapley``, all longs, for every order of the filters.

    ``fails`` is an array of booleans, one for each letter, null counting as
    not failed; ``weights`` are whole numbers by row: the documents that it
    stands for, then others, null counting as 0. A null part stays null.
    Every part gets all orders and steps. An empty table gives no rows. A row
    a part, of at most 2^filters counts, goes to the matrices.
    """
    filters = len(letters)
    if filters > MOST_FILTERS:
        raise ValueError(f"all orders of {filters} filters are too many to list")
    sums = [f"sum{i}" for i in range(len(weights))]
    mask = sum((F.when(F.get(F.col(fails), i), 1 << i).otherwise(0) for i in range(filters)), F.lit(0))
    counted = rows.select(F.col(part).alias("part"), mask.alias("mask"), *[
        F.coalesce(w if isinstance(w, Column) else F.col(w), F.lit(0)).cast("long").alias(s)
        for w, s in zip(weights, sums, strict=True)]).groupBy("part", "mask").agg(*[F.sum(s).alias(s) for s in sums])
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *sums)).alias("counts"))
    orders = ["".join(o) for o in permutations(letters)]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        positions, _ = removal_steps(filters)
        at = np.argsort(positions, axis=1)  # the filter at each step
        for frame in frames:
            for name, found in zip(frame["part"], frame["counts"], strict=True):
                counts = np.zeros((1 << filters, len(sums)), np.int64)
                for row in found:
                    counts[row["mask"]] = [row[s] for s in sums]
                got = interactions(counts, filters)
                yield pd.DataFrame({
                    "part": name, "filter_order": np.repeat(orders, filters), "step": np.tile(np.arange(1, filters + 1), len(orders)),
                    **{c: got[c].ravel() for c in ("kept", "removed", "redundant")},
                    "unique_fails": got["alone"][at].ravel(),
                    **{c: got["lost"][:, :, i].ravel() for i, c in enumerate(names)},
                    "shapley": got["shapley"][at].ravel()}).astype({"step": "int32"})

    longs = ", ".join(f"`{c}` long" for c in ("kept", "removed", "redundant", "unique_fails", *names, "shapley"))
    return by_part.mapInPandas(work, f"part string, filter_order string, step int, {longs}")


def audit_rules(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                part: str = "source") -> DataFrame:
    """The audit of the rules A to E on ``docs``, with the removed documents
    that ``labels`` (``quality``, ``toxic`` by id) calls good or toxic, as
    ``good_lost`` and ``toxic_lost``. If an id has several labels, one 1
    will do; a document without a label, or with a null id, is neither."""
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    rows = fail_rules(docs, id_column, text, part)
    rows = rows.join(known, F.col("id") == F.col("labelled"), "left")
    return audit(rows, "fails", "part", ["copies", F.col("copies") * F.col("good"), F.col("copies") * F.col("toxic")],
                 ["good_lost", "toxic_lost"])
