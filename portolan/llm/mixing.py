"""Temperature mixing of sources, in SQL functions only.

A source's share of all tokens, raised to an exponent and normalised, is its
weight: exponent 1 keeps the corpus as it is, 0 gives every source the same.
The exponent is bisected until the weights meet a target entropy or a limit
on repetition. The weights are realised without dropping a document: the
source with the lowest weight to share ratio is read once, the others as many
times as their weights ask for, the last time in part: its blocks in a keyed
permutation, until the tokens due are used up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, text_or_empty
from portolan.operators.joins import maybe_broadcast

REPEATS = 4.0
BLOCK_ROWS = 4096  # rows of a block, about
TOKEN_BYTES = 4  # UTF-8 bytes of a token, about
_CUTS = 15  # exponents tried in one pass; each pass keeps a sixteenth of the range
_PASSES = 8


def source_shares(rows: DataFrame) -> DataFrame:
    """``source, tokens, rows, share`` from rows with ``source, n_tokens``,
    combined in each task before they move. One row for each source."""
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    totals = cut(totals)
    whole = totals.agg(F.sum("tokens")).first()[0] or 1
    return totals.withColumn("share", F.col("tokens") / F.lit(whole))


def fit_exponent(shares: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None) -> float:
    """The exponent in [0, 1]: the smallest that repeats no source more than
    ``repeats`` times, or, if ``entropy`` (in nats) is given, the largest
    whose weights have at least that entropy. Both fall with the exponent's
    distance from its bound, so the range is cut down pass by pass, each one
    aggregation over the sources; the driver sees two numbers for each
    exponent tried. One source, or none, gives 1; an entropy beyond that of
    equal weights gives 0."""
    low, high = 0.0, 1.0

    def fits(tried: list[float]) -> list[bool]:
        aggs = []
        for i, a in enumerate(tried):
            p = F.pow("share", F.lit(a))
            z = F.sum(p)
            aggs.append((F.log(z) - F.lit(a) * F.sum(p * F.log("share")) / z).alias(f"h{i}"))
            ratio = F.pow("share", F.lit(a - 1.0))
            aggs.append((F.max(ratio) / F.min(ratio)).alias(f"r{i}"))
        got = shares.agg(*aggs).first()
        if entropy is not None:
            return [got[f"h{i}"] is not None and got[f"h{i}"] >= entropy for i in range(len(tried))]
        return [got[f"r{i}"] is None or got[f"r{i}"] <= repeats for i in range(len(tried))]

    at_ends = fits([low, high])
    if entropy is None and at_ends[0]:
        return 1.0 if shares.limit(2).count() < 2 else 0.0
    if entropy is not None and (at_ends[1] or not at_ends[0]):
        return 1.0 if at_ends[1] else 0.0
    for _ in range(_PASSES):
        tried = [low + (high - low) * i / (_CUTS + 1) for i in range(1, _CUTS + 1)]
        ok = fits(tried)
        marks = [low, *tried, high]
        if entropy is None:  # false ... true: keep the first that fits as the upper end
            i = ok.index(True) + 1 if True in ok else len(tried) + 1
        else:  # true ... false: the last that fits is the lower end
            i = ok.index(False) + 1 if False in ok else len(tried) + 1
        low, high = marks[i - 1], marks[i]
    return high if entropy is None else low


def mix(docs: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, seed: int = 7,
        id_column: str = "doc_id", text: str = "text", source: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """How often each document is read: ``doc_id, text_hash, source,
    n_tokens, weight, block, copies``, a row for each row of ``docs``.

    Tokens are counted without a tokenizer as one for every ``TOKEN_BYTES``
    UTF-8 bytes begun, plus one for the document's end, so scripts without
    spaces count too and an empty or null text has one. A null source is a
    source of its own. Blocks are hashes of
    the row's id and text dealt within its source, so a source that holds
    most rows has most blocks, and no task gets a whole source. A partial
    reading takes whole blocks in the order of a keyed hash and the rows of
    the last one, in such an order too, while they fit the tokens due. An
    empty table gives no rows.
    """
    body = text_or_empty(text)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(body).alias("text_hash"), F.col(source).alias("source"),
                       (F.ceil(F.octet_length(body) / TOKEN_BYTES) + 1).cast("long").alias("n_tokens"))
    rows = cut(rows)
    shares = source_shares(rows)
    exponent = fit_exponent(shares, repeats, entropy)
    lifted = shares.withColumn("lifted", F.pow("share", F.lit(exponent)))
    total, least = lifted.agg(F.sum("lifted"), F.min(F.col("lifted") / F.col("share"))).first()
    plan = lifted.select(
        F.col("source").alias("of"), (F.col("lifted") / F.lit(total or 1.0)).alias("weight"),
        F.greatest(F.lit(1.0), F.round(F.col("lifted") / F.col("share") / F.lit(least or 1.0), 9)).alias("readings"),
        "tokens",
        F.greatest(F.lit(1), F.expr(f"rows DIV {block_rows}")).alias("blocks")).select(
        "*", F.floor("readings").alias("whole"),
        ((F.col("readings") - F.floor("readings")) * F.col("tokens")).cast("long").alias("due"))
    dealt = rows.join(maybe_broadcast(plan), rows["source"].eqNullSafe(plan["of"])).withColumn(
        "turn", F.xxhash64(F.lit(seed), "doc_id", "text_hash")).withColumn("block", F.pmod("turn", "blocks"))
    # Tokens of the blocks that come before, in the permuted order.
    order = Window.partitionBy("of").orderBy(F.xxhash64(F.lit(seed), "block"), "block").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("of", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    blocks = blocks.select(F.col("of").alias("of_"), F.col("block").alias("block_"),
                           F.coalesce(F.sum("block_tokens").over(order), F.lit(0)).alias("before"))
    same = dealt["of"].eqNullSafe(blocks["of_"]) & (dealt["block"] == blocks["block_"])
    within = Window.partitionBy("of", "block").orderBy(
        F.xxhash64(F.lit(seed + 1), "turn"), "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(blocks, same).withColumn("used", F.col("before") + F.sum("n_tokens").over(within))
    return placed.select("doc_id", "text_hash", "source", "n_tokens", "weight", "block",
                         (F.col("whole") + (F.col("used") <= F.col("due")).cast("long")).cast("int").alias("copies"))


def readings(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """A row for each reading of a document: ``mix``'s columns without
    copies, ``reading`` from 0, and ``place``, a keyed hash whose order
    interleaves the sources."""
    return mixed.withColumn("reading", F.explode(F.expr("sequence(0, copies - 1)"))).withColumn(
        "place", F.xxhash64(F.lit(seed), "reading", "doc_id", "text_hash")).drop("copies")


def repeat_rows(docs: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, seed: int = 7,
                id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs``, each row as often as the mixture reads it, with its columns.
    Rows that repeat both id and text within a source are read alike."""
    names = [fresh(docs, c) for c in ("mixed_id", "mixed_hash", "mixed_source", "mixed_copies", "own_hash")]
    own = names[4]
    more = cut(mix(docs, repeats, entropy, seed, id_column, text, source).where("copies > 1")
               .groupBy("doc_id", "text_hash", "source").agg(F.min("copies").alias("copies"))
               .toDF(*names[:4]))
    left = docs.withColumn(own, F.xxhash64(text_or_empty(text)))
    same = (F.col(id_column).eqNullSafe(F.col(names[0])) & (F.col(own) == F.col(names[1]))
            & F.col(source).eqNullSafe(F.col(names[2])))
    both = left.join(maybe_broadcast(more), same, "left")
    extra = fresh(both, "reading")
    times = F.sequence(F.lit(1), F.coalesce(F.col(names[3]), F.lit(1)))
    return both.withColumn(extra, F.explode(times)).drop(*names, extra)
