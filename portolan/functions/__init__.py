"""Column functions: native Spark expressions only, no Python UDFs."""

from portolan.functions.dates import days_since_sas_epoch, sas_to_date, sas_to_date_text, time_parts
from portolan.functions.nulls import complete_rows, is_missing
from portolan.functions.text import region_suffix

__all__ = [
    "days_since_sas_epoch", "sas_to_date", "sas_to_date_text", "time_parts",
    "complete_rows", "is_missing", "region_suffix",
]
