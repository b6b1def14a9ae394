"""Code -> label decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import BROADCAST_MAX_ROWS, maybe_broadcast

# Lists the source catalog states only in comments or as a
# handful of entries (arrival mode; visa category).
ARRIVAL_MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}

# Fixed value: label for a code that is not in its list.
OTHER = "Other"


def decode_constant(code: Column | str, mapping: dict, default: str = OTHER) -> Column:
    """Label from a small fixed mapping, as a literal map (no join)."""
    c = F.col(code) if isinstance(code, str) else code
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, c), F.lit(default))


def decode_join(df: DataFrame, code_col: str, lookup: DataFrame, out_col: str,
                default: str = OTHER, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ``out_col`` = label of ``code_col`` from a (code, label) frame.

    Left join, so unmatched and null codes keep their row and get
    ``default``. The lookup is broadcast after its size check.
    """
    lk = lookup.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    j = df.join(maybe_broadcast(lk, max_rows), df[code_col] == lk["_code"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_label"), F.lit(default))).drop("_code", "_label")
