"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def region_suffix(region: Column | str) -> Column:
    """Second '-'-separated item: 'US-CA' -> 'CA', 'US-U-A' -> 'U'.

    No dash or null gives null (``split_part`` would give '').
    """
    r = F.col(region) if isinstance(region, str) else region
    return F.try_element_at(F.split(r, "-"), F.lit(2))
