"""Small document tables with every awkward case, and plain-Python versions."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

# Extra columns whose names the operators use themselves.
CLASHES = ("size", "shard", "slot", "row", "range", "fp", "text_sha256", "text_hash", "lines", "gone", "own_hash",
           "copies", "block", "reading", "gone_id", "rejected_id", "id", "key", "n_lines", "n_removed", "own", "own_from",
           "own_to", "fp_w", "fp_s", "fp_t", "fp_m", "_range", "_copy", "_head", "_of", "_to", "_head_id", "_head_tie",
           "range_of", "range_bounds", "go_id", "go_sha256", "stays", "n", "no_id", "nth", "mixed_id", "mixed_copies",
           "rejected_hash", "gone_hash", "ll", "best", "body", "source_", "count")


def words(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}x"[:6] for _ in range(n))


def awkward_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(3, 120)) + ".\n" + words(rng, 30) + "." for _ in range(25)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 5], "en", "src0", 1) for i in range(20)]  # copies, a hot source
    rows += [(200, None, None, None, None), (201, "", "en", "src1", 0), (202, " \n\t ", "en", "src1", 4),
             (None, base[3], "en", "src2", 5), (None, None, None, None, None),
             (203, "one", "en", "src2", 3), (204, "Ünï çödé 日本語 🎉 ok", "fr", "src1", 17),
             (205, " ".join([base[0]] * 200), "en", "src0", 9)]  # very long
    return rows + [rows[0], rows[0]]  # repeated rows


def documents(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})
    return df
