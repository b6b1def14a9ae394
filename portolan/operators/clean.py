"""Cleaning of the four sources: filters, projections, renames, casts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions.nulls import complete_rows
from portolan.operators.joins import semi_join
from portolan.schemas import ARRIVALS_INT_CODES, ARRIVALS_KEPT, CITIES_KEPT, PORTS_KEPT


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows with no null (and no NaN in float columns) among ``cols``.

    Same rows as ``df.na.drop('any', subset=cols)``, written as a pushable
    conjunction.
    """
    return df.filter(complete_rows(df, cols))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct. Planned as a partial (map-side) + final hash
    aggregate, so heavy copies of one row collapse before the shuffle."""
    return df.dropDuplicates()


def row_digest(cols: list[str]) -> list[Column]:
    """256 bits of the columns' values as four longs, ``_digest0`` and so on.

    Nulls are marked beside the values; floats are equal where a distinct
    takes them as equal (0.0 and -0.0, NaN and NaN). Rows with equal digests
    are the same row for any number of rows that can be stored.
    """
    named = [F.col(f"`{c}`") for c in cols]
    marks = [reduce(Column.bitwiseOR, [F.when(c.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                                       for i, c in enumerate(named[at:at + 62])]) for at in range(0, len(named), 62)]
    return [F.xxhash64(F.lit(seed), *named, *marks).alias(f"_digest{seed}") for seed in range(4)]


def clean_cities(raw: DataFrame) -> DataFrame:
    """City rows with both a city name and a state code; Race/Count dropped."""
    return (raw.filter(F.col("`State Code`").isNotNull() & F.col("City").isNotNull())
            .select(*[F.col(f"`{c}`") for c in CITIES_KEPT]))


def clean_ports(raw: DataFrame) -> DataFrame:
    """US ports with an IATA code that are not closed.

    Three-valued logic: a null ``type`` fails ``type != 'closed'`` and is
    removed as well.
    """
    return (raw.filter(F.col("iata_code").isNotNull()
                       & (F.col("iso_country") == "US")
                       & (F.col("type") != "closed"))
            .select(*PORTS_KEPT))


def clean_temperatures(raw: DataFrame, country: str = "United States") -> DataFrame:
    """One country's rows as (city, avg_temp, avg_temp_uncertainty), complete only."""
    out = raw.filter(F.col("Country") == country).select(
        F.col("City").alias("city"),
        F.col("AverageTemperature").alias("avg_temp"),
        F.col("AverageTemperatureUncertainty").alias("avg_temp_uncertainty"),
    )
    return drop_incomplete(out)


def select_kept_arrivals(raw: DataFrame, carry: tuple[str, ...] = (), distinct: bool = True) -> DataFrame:
    """Full-row distinct over all raw columns, then the kept columns only.

    Two rows equal on the kept columns but different elsewhere (e.g.
    ``admnum``) are both kept, so a digest of the whole row goes through the
    distinct beside the kept columns; the others aren't shuffled.
    ``distinct=False`` leaves copies in, for what ignores them (distinct
    dates, a highest age).
    """
    if not distinct:
        return raw.select(*ARRIVALS_KEPT, *carry)
    named = raw.select(*ARRIVALS_KEPT, *carry, *row_digest(raw.columns))
    return dedup_rows(named).select(*ARRIVALS_KEPT, *carry)


def _beyond_int(c: str) -> Column:
    """A number whose whole part no int can hold."""
    return ~((F.col(c) > -2147483649.0) & (F.col(c) < 2147483648.0))


def rejected_arrivals(raw: DataFrame) -> DataFrame:
    """``cause, rows``: distinct raw rows that cleaning refuses, per cause,
    each row under its first: ``incomplete``, or ``<column> out of range``."""
    kept = select_kept_arrivals(raw)
    cause = F.when(~complete_rows(kept, ARRIVALS_KEPT), F.lit("incomplete"))
    for c in ARRIVALS_INT_CODES:
        cause = cause.when(_beyond_int(c), F.lit(f"{c} out of range"))
    return (kept.select(cause.alias("cause")).filter("cause IS NOT NULL")
            .groupBy("cause").agg(F.count(F.lit(1)).alias("rows")))


def _int_codes(kept: DataFrame) -> DataFrame:
    for c in ARRIVALS_INT_CODES:
        kept = kept.filter(F.col(c).isNull() | ~_beyond_int(c))
    return kept


def accepted_arrivals(raw: DataFrame) -> DataFrame:
    """Raw rows, copies included, that cleaning keeps: complete in the kept
    columns and with codes that an int can hold."""
    return _int_codes(drop_incomplete(raw, ARRIVALS_KEPT))


def type_arrivals(kept: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rename and cast the kept arrival columns to the fact-table types.

    Double codes are truncated toward zero. Rows with a code that no int can
    hold are refused (``rejected_arrivals`` counts them), so no key turns
    null on the way; the conditions are plain comparisons and reach the scan.
    """
    kept = _int_codes(kept)
    as_int = lambda c: F.col(c).try_cast("int")
    return kept.select(
        as_int("cicid").alias("immigration_id"),
        as_int("i94cit").alias("origin"),
        F.col("i94port").alias("landing_port"),
        F.col("arrdate").alias("arrival_date"),
        as_int("i94mode").alias("arrival_mode"),
        F.col("i94addr").alias("state"),
        F.col("depdate").alias("departure_date"),
        as_int("i94bir").alias("age"),
        as_int("i94visa").alias("visa"),
        F.col("visatype"),
        F.col("gender"),
        *carry,
    )


def clean_arrivals(raw: DataFrame, carry: tuple[str, ...] = (), ports: DataFrame | None = None,
                   distinct: bool = True, without_port: bool = False) -> DataFrame:
    """Distinct, projected, complete and typed arrivals.

    The completeness filter only touches kept columns, so Catalyst moves it
    below the distinct and into the scan. With ``ports`` (columns
    ``iso_region, iata_code``, as the fact join takes them), rows that have
    no port are left out below the distinct: whether a row has one depends
    on two of its own columns, so the result joined to ports is the same,
    and the one wide shuffle carries only rows that reach the fact.
    ``without_port`` takes the other rows instead, those without one.
    """
    if ports is not None:
        match = (F.col("i94addr") == F.col("iso_region")) & (F.col("i94port") == F.col("iata_code"))
        raw = raw.join(ports, match, "left_anti") if without_port else semi_join(raw, ports, match)
    kept = select_kept_arrivals(raw, carry, distinct)
    return type_arrivals(drop_incomplete(kept, ARRIVALS_KEPT), carry)
