"""SAS day numbers and calendar parts.

A SAS date is a count of days since 1960-01-01, stored as a double. The
conversion floors the value, so 20454.7 is 2016-01-01 and -0.5 is
1959-12-31 (whole days of a Python ``date + timedelta``).
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: origin of SAS day numbers.
SAS_EPOCH = datetime.date(1960, 1, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_to_date(x: Column | str) -> Column:
    """Double day number -> DATE; null, NaN or out-of-range -> null."""
    c = _col(x)
    days = F.floor(c).try_cast("int")
    return F.when(~F.isnan(c), F.date_add(F.lit(SAS_EPOCH), days))


def sas_to_date_text(x: Column | str) -> Column:
    """Day number -> 'YYYY-MM-DD' text (the form the reference UDF returned)."""
    return F.date_format(sas_to_date(x), "yyyy-MM-dd")


def days_since_sas_epoch(d: Column | str) -> Column:
    """DATE or TIMESTAMP -> whole days since 1960-01-01 as a double."""
    return F.datediff(F.to_date(_col(d)), F.lit(SAS_EPOCH)).cast("double")


def time_parts(d: Column | str) -> dict[str, Column]:
    """Calendar parts of a DATE: ISO week, weekday 1 = Sunday ... 7 = Saturday."""
    d = _col(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "week": F.weekofyear(d),
        "weekday": F.dayofweek(d),
    }


def month_key(x: Column | str) -> Column:
    """'yyyy-MM' month of a SAS day number; the unit of a monthly source file."""
    return F.date_format(sas_to_date(x), "yyyy-MM")
