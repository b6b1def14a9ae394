"""The fact table and its match-loss report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.dates import month_key
from portolan.operators.clean import accepted_arrivals, clean_arrivals, drop_incomplete, row_digest
from portolan.operators.joins import BROADCAST_MAX_ROWS, has_at_most, maybe_broadcast

FACT_COLUMNS = ["immigration_id", "origin", "landing_port", "arrival_date", "departure_date",
                "arrival_mode", "city", "age", "visa", "visatype", "gender"]


def _port_match(arrivals: DataFrame, ports: DataFrame):
    return ((arrivals["state"] == ports["iso_region"])
            & (arrivals["landing_port"] == ports["iata_code"]))


def port_side(ports: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The port columns the fact join needs, broadcast-hinted when the size
    check passes. Check once and reuse it when the same ports meet many
    arrival frames (micro-batches).

    Beyond the check the joins shuffle, and arrivals without a port should
    not: Spark then tests them at the scan against a Bloom filter of the port
    codes. It makes one only of a side that a comparison filters, so the side
    gets one that holds for every code (a null code has no match).
    """
    side = ports.select("iso_region", "iata_code", "city")
    if has_at_most(side, max_rows):
        return F.broadcast(side)
    return side.filter(F.col("iata_code") >= "")


def fact_arrivals(arrivals: DataFrame, ports: DataFrame, carry: tuple[str, ...] = (),
                  max_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """Typed arrivals joined to ports on (state, landing port); city from the port.

    Arrivals without a port are dropped (see ``match_rate_by_month``). The
    port dimension is broadcast when its size check passes; otherwise the
    join shuffles on both keys and AQE splits hot keys. ``max_rows=None``
    takes ``ports`` as it is (already prepared by ``port_side``).
    """
    p = port_side(ports, max_rows) if max_rows is not None else ports
    joined = arrivals.join(p, _port_match(arrivals, p), "inner")
    return joined.select(*FACT_COLUMNS, *carry)


def fact_from_raw(raw: DataFrame, ports: DataFrame, carry: tuple[str, ...] = (), distinct: bool = True,
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The fact straight from raw arrivals: the port side's size is checked
    once and serves both the existence join below the distinct and the join
    above it. ``carry`` names typed columns that ``raw`` holds besides.
    ``distinct=False`` keeps copies of raw rows."""
    side = port_side(ports, max_rows)
    arrivals = clean_arrivals(raw, carry, ports=side.select("iso_region", "iata_code"), distinct=distinct)
    return fact_arrivals(arrivals, side, carry, max_rows=None)


def match_rate_by_month(arrivals: DataFrame, ports: DataFrame) -> DataFrame:
    """Per arrival month: cleaned rows in, fact rows out.

    Arrivals are first counted per (month, state, port), so only that small
    aggregate meets the port multiplicities; the result equals counting the
    join rows.
    """
    pre = (arrivals.groupBy(month_key("arrival_date").alias("month"),
                            F.col("state"), F.col("landing_port"))
           .agg(F.count(F.lit(1)).alias("n")))
    mult = ports.groupBy("iso_region", "iata_code").agg(F.count(F.lit(1)).alias("m"))
    j = pre.join(mult, _port_match(pre, mult), "left")
    return j.groupBy("month").agg(
        F.sum("n").alias("rows_in"),
        F.sum(F.col("n") * F.coalesce(F.col("m"), F.lit(0))).alias("rows_matched"),
    )


def match_rate_of_raw(raw: DataFrame, ports: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``match_rate_by_month`` straight from raw arrivals, in one pass: each
    accepted row gets its number of ports and goes through the distinct as
    month, that number and its digest."""
    many = maybe_broadcast(ports.groupBy("iso_region", "iata_code").agg(F.count(F.lit(1)).alias("m")), max_rows)
    match = (F.col("i94addr") == F.col("iso_region")) & (F.col("i94port") == F.col("iata_code"))
    rows = accepted_arrivals(raw).join(many, match, "left").select(
        month_key("arrdate").alias("month"), F.coalesce("m", F.lit(0)).alias("m"), *row_digest(raw.columns)).distinct()
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("rows_in"), F.sum("m").alias("rows_matched"))


def match_loss(raw: DataFrame, ports: DataFrame, written: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Per arrival month: fact rows, and cleaned arrivals that have no port.

    For a load that has written its fact (``written``, with
    ``arrival_date``): what matched is counted there, and only the rows
    without a port, which the load left out below its distinct, are made
    distinct here. So each raw row goes through one of the two distincts.
    """
    side = port_side(ports, max_rows).select("iso_region", "iata_code")
    lost = clean_arrivals(raw, ports=side, without_port=True)
    month = month_key("arrival_date").alias("month")
    parts = written.select(month, F.lit(1).alias("matched"), F.lit(0).alias("lost")).unionByName(
        lost.select(month, F.lit(0).alias("matched"), F.lit(1).alias("lost")))
    return parts.groupBy("month").agg(F.sum("matched").alias("rows_matched"), F.sum("lost").alias("rows_lost"))


def stack_months(*frames: DataFrame) -> DataFrame:
    """Union all of per-month frames, matched by column name.

    Reading several months is better done as one multi-month read
    (``files.read_months``); this is for frames that already exist.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def distinct_complete_count(df: DataFrame) -> DataFrame:
    """Count of distinct rows with no null/NaN, as a one-row frame."""
    return drop_incomplete(df.dropDuplicates()).agg(F.count(F.lit(1)).alias("n_rows"))
