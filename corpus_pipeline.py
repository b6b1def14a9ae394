"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are applied in order, each to all that the one before kept; each
result is written as Parquet in the shared folder and read again, so a lost
executor costs no more than a part of one stage. All but the last return the
columns of ``documents``.

Stages that work on texts in Python send them in batches of bounded bytes;
they do so in jobs that have run when the stage returns its rows.

Every stage takes nulls in any column, empty and very long texts, repeated
rows, empty tables and extra columns, as its operator's docstring says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from portolan.llm import exact_dedup, language_id, mixing, packing, simhash
from portolan.llm.common import small_batches
from portolan.session import remove_path, scratch_path
from portolan.sources.files import exists

SHINGLE, DISTANCE = 3, 3  # of the near-duplicate stage
REPEATS = 4.0  # readings of a source's documents, at most


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no known language: texts without letters
    (empty and null ones too) and those less likely in each language than at
    random. ``lang`` is the declared language and ``source`` the host."""
    with small_batches(spark):
        return language_id.keep_known(docs, language_id.fit(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the largest id of those with equal texts."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component."""
    with small_batches(spark):
        return simhash.keep_one(docs, SHINGLE, DISTANCE)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of smaller sources; drops none."""
    return mixing.repeat_rows(docs, repeats=REPEATS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document; a row for each piece, with its sequence."""
    with small_batches(spark):
        return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mixture),
    ("packing", sequences),
]

# The trigram model, the components and the packing search have no SQL; the
# tests hold run() against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over ``documents``. A stage's rows are removed once the next
    stage's are written. A run that is given the ``folder`` of one that failed
    goes on behind its last finished stage; without one it takes a new folder
    below the shared one."""
    folder = folder or scratch_path(spark, "corpus-pipeline", uuid.uuid4().hex)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    paths = [f"{folder}/{name}" for name, _ in STAGES]
    done = max((i for i, path in enumerate(paths) if exists(spark, f"{path}/_SUCCESS")), default=-1)
    if done >= 0:
        docs = spark.read.parquet(paths[done])
    for i in range(done + 1, len(STAGES)):
        out = STAGES[i][1](spark, docs, sf_dir)
        out.write.mode("overwrite").parquet(paths[i])
        docs = spark.read.schema(out.schema).parquet(paths[i])
        if i:
            remove_path(spark, paths[i - 1])
    return docs
