"""Exact dedup by content-defined chunk recipes.

Each text is cut where its own content says so, at least ``MIN_CHUNK``
characters on: after the first sentence end or line feed that stands before
certain letters, if one comes within ``NEAR_CHUNK`` characters, else at the
first white space between such letters, if one does, else after the first few
such letters in a row, and at ``MAX_CHUNK`` characters at the latest. So
texts without punctuation or spaces (code, tables, other scripts, encoded
bytes) are cut by content too. Chunks are deduplicated by hash and text;
hashes that stand for one text only are verified identifiers, the others get
an ordinal beside the hash. A document is then the ordered list of its
chunks' identifiers, and documents are compared by that list. A text moves
once, as chunks of which each map task sends one copy; long documents are
never grouped, sorted or joined as a whole (``keep_one`` does so only for the
rows whose keys are too many to broadcast, and for rows that repeat id and
text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.common import cut, fresh, text_or_empty
from portolan.operators.joins import maybe_broadcast

MIN_CHUNK, NEAR_CHUNK, MAX_CHUNK = 256, 1024, 4096
# About a third of the letters and digits of each script, and of the ideographs
# and syllables an eighth. Cut points that ask for a few of them in a row come
# every hundred characters or two, so that shifted texts meet at the same ones.
_SOME = ("adgjmpsvyADGJMPSVY0369" r"\u0391-\u0397\u03B1-\u03B7\u0410-\u0419\u0430-\u0439\u05D0-\u05D7"
         r"\u0627-\u062F\u0915-\u0922\u0E01-\u0E0F")
_SIGNS = r"\u3042-\u304F\u4E00-\u57FF\uAC00-\uAFFF"


def chunks(text: Column, least: int = MIN_CHUNK, near: int = NEAR_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; joined, they are the text."""
    ends = rf"(?:\n(?=\s{{0,16}}+[{_SOME}{_SIGNS}])|[.!?](?=\s|\z)|[\u3002\uFF01\uFF1F\u0964\u06D4])"
    between = rf"[{_SOME}]\s[{_SOME}]{{2}}"
    inside = rf"(?:[{_SOME}]{{5}}|[{_SIGNS}]{{3}})"
    pattern = (rf"(?s).{{{least},{near - 1}}}?{ends}|.{{{least},{near - 4}}}?{between}|"
               rf".{{{least},{most - 5}}}?{inside}|.{{1,{most}}}")
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """Groups of documents whose texts are identical.

    Returns, for each row, ``doc_id, keep_id, group_size, kept,
    text_sha256``: of equal texts the row with the largest id stays.
    ``hash_bits`` shortens the chunk hash (tests use few bits, so that hashes
    meet and the ordinals decide).

    Null text counts as empty, and all empty texts are equal. A null id is
    below all others; a group with null ids only keeps its rows. Rows that
    repeat both id and text are one document, so all of them are kept or
    none. An empty table gives no rows. Other columns are not read.
    """
    mask = (1 << hash_bits) - 1

    def ident(c: Column) -> Column:
        return F.xxhash64(c) if hash_bits == 64 else F.xxhash64(c).bitwiseAND(F.lit(mask))

    body = text_or_empty(text)
    cutup = docs.select(F.col(id_column).alias("doc_id"), F.sha2(body.cast("binary"), 256).alias("text_sha256"),
                        chunks(body).alias("chunks"))
    recipes = cutup.select("doc_id", "text_sha256", F.transform("chunks", ident).alias("recipe"))
    pieces = cutup.select(F.explode("chunks").alias("chunk")).select(ident(F.col("chunk")).alias("id"), "chunk")
    distinct = pieces.distinct()
    unsure = cut(distinct.groupBy("id").count().where("count > 1").select("id"))
    if unsure.isEmpty():
        recipes = recipes.withColumn("marks", F.array().cast("array<struct<pos:int,nth:int>>"))
    else:
        recipes = _with_ordinals(cutup, recipes, distinct, unsure, ident)
    groups = recipes.groupBy("recipe", "marks").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    shared = groups.where("group_size > 1")
    return recipes.join(shared, ["recipe", "marks"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256")


def _with_ordinals(cutup: DataFrame, recipes: DataFrame, distinct: DataFrame, unsure: DataFrame, ident) -> DataFrame:
    """Recipes with the ordinals of those chunks whose hash several texts
    share: ``marks`` lists position and ordinal. Only such chunks move."""
    named = distinct.join(unsure, "id", "left_semi").select(
        "id", "chunk", F.row_number().over(Window.partitionBy("id").orderBy("chunk")).alias("nth"))
    placed = cutup.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk")) \
        .withColumn("id", ident(F.col("chunk")))
    marks = (placed.join(named, ["id", "chunk"]).groupBy("doc_id", "text_sha256")
             .agg(F.array_sort(F.collect_set(F.struct("pos", "nth"))).alias("marks")))
    same = recipes["doc_id"].eqNullSafe(marks["doc_id"]) & (recipes["text_sha256"] == marks["text_sha256"])
    none = F.array().cast("array<struct<pos:int,nth:int>>")
    return recipes.join(marks, same, "left").select(
        recipes["doc_id"], recipes["text_sha256"], "recipe", F.coalesce("marks", none).alias("marks"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one row of each, with their columns. Which of
    the rows that repeat both id and text stays is open.

    Only the keys of rows that go or repeat are joined, by broadcast after a
    check of their size, so a text that stays doesn't move; beyond the bound
    the join shuffles.
    """
    sha, go_id, go_sha, stays = (fresh(docs, c) for c in ("text_sha256", "go_id", "go_sha256", "stays"))
    keys = cut(exact_groups(docs, id_column, text).where("NOT kept OR group_size > 1").groupBy(
        F.col("doc_id").alias(go_id), F.col("text_sha256").alias(go_sha)).agg(
        F.bool_or("kept").alias(stays), F.count(F.lit(1)).alias("n")).where(f"NOT {stays} OR n > 1").drop("n"))
    named = docs.withColumn(sha, F.sha2(text_or_empty(text).cast("binary"), 256))
    same = F.col(id_column).eqNullSafe(F.col(go_id)) & (F.col(sha) == F.col(go_sha))
    kept = named.join(maybe_broadcast(keys), same, "left_anti")
    repeated = keys.where(stays)
    if not repeated.isEmpty():
        again = named.join(maybe_broadcast(repeated), same, "left_semi").dropDuplicates([id_column, sha])
        kept = kept.unionByName(again)
    return kept.drop(sha)
