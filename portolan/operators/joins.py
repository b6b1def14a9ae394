"""Join helpers: size-checked broadcast, existence joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when it is proven to hold at most this many
# rows and about this many bytes. Dimensions of this pipeline are bounded by
# nature (ports on earth, cities, calendar days), but the check keeps a grown
# one on the shuffle path. The byte bound matches the runtime broadcast
# threshold of ``session.scale_conf``.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20

_VAR_WIDTH = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _payload_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of ``df``'s rows as Spark holds them
    (8-byte null bits and 8 bytes per field, plus the variable-length bytes
    of text, binary and nested values; nested values measured as JSON)."""
    per_row = 8 + 8 * len(df.schema.fields)
    var = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _VAR_WIDTH):
            var.append(F.octet_length(c))
        elif isinstance(f.dataType, _NESTED):
            var.append(F.octet_length(F.to_json(c)))
    total = F.count(F.lit(1)) * per_row
    for v in var:
        total = total + F.coalesce(F.sum(v), F.lit(0))
    return total


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of ``df`` in one aggregation.

    Every task sums its own rows and only one partial result per task is
    combined, so the check costs one pass over the dimension and never
    funnels rows into a single task (a global ``limit(n + 1)`` would).
    """
    row = df.agg(F.count(F.lit(1)).alias("rows"), _payload_bytes(df).alias("bytes")).first()
    return int(row["rows"]), int(row["bytes"])


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes``
    estimated bytes."""
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint on ``small`` only after its size is checked.

    Beyond either bound the plain frame is returned: Spark plans a shuffle
    join (AQE may still switch to broadcast from runtime sizes, and splits
    skewed partitions of a sort-merge join).
    """
    return F.broadcast(small) if has_at_most(small, max_rows, max_bytes) else small


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column | list | str,
                   how: str = "inner", max_rows: int | None = None) -> DataFrame:
    """Join a large frame to a dimension.

    With ``max_rows`` the dimension is counted first (``maybe_broadcast``);
    use that only where the dimension's lineage is cheap (a standalone
    source or a written table). Without it no hint is given: the planner
    broadcasts on its size estimate and AQE re-plans from the measured size
    of the shuffled side, so a dimension derived from the fact is never
    computed twice just to be measured.
    """
    side = maybe_broadcast(dim, max_rows) if max_rows is not None else dim
    return fact.join(side, on, how)


def semi_join(left: DataFrame, right: DataFrame, on: Column | list | str) -> DataFrame:
    """Rows of ``left`` with at least one match in ``right`` (EXISTS).

    Never multiplies ``left`` rows and keeps only ``left`` columns; the
    strategy (broadcast or shuffle) is left to the planner and AQE.
    """
    return left.join(right, on, "left_semi")


def join_using(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """USING join: equal key names on both sides, one key column in the output."""
    return left.join(right, keys, how)
