"""Counts of the fact per month, kept with it and replaced with its months.

A fact of many years is asked the same questions after each load: arrivals
by weekday, port type and city, the highest age, value counts. Each sums
counts over the whole fact. So a load counts the months it wrote, once, in
one aggregation over all ``GROUPINGS``, and the questions sum those counts: a
reload of one month recounts that month alone, and no question reads the fact.

A row is one value of one grouping in one month: ``grouping`` names it, its
columns hold the value (the other columns are null) and ``n`` the rows. A
value may be null, and then counts like any other. Counts lie beside the
fact's month (``versions/<id>/fact_counts/month=<month>``), so a published
version (``sources.published``) names both at once. A month stored without
counts is counted from its rows when it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.dates import month_key
from portolan.operators.joins import join_dimension
from portolan.schemas import FACT_IMMIGRATIONS
from portolan.sources import files, published

GROUPINGS = {
    "day": ["arrival_date"],
    "port": ["city", "landing_port"],
    "age": ["age"],
    "origin": ["origin"],
    "visa": ["visa"],
    "visatype": ["visatype"],
    "arrival_mode": ["arrival_mode"],
    "gender": ["gender"],
}
_COLUMNS = [c for cols in GROUPINGS.values() for c in cols]
SCHEMA = T.StructType([T.StructField("grouping", T.StringType()),
                       *[FACT_IMMIGRATIONS[c] for c in _COLUMNS], T.StructField("n", T.LongType())])


def count_months(fact: DataFrame) -> DataFrame:
    """``month`` and the columns of ``SCHEMA``: all groupings of each month
    in one pass. Each task counts its own rows first, so a value that most
    rows hold sends one row a task."""
    named = fact.select(month_key("arrival_date").alias("month"), *_COLUMNS)
    sets = [[F.col("month"), *[F.col(c) for c in cols]] for cols in GROUPINGS.values()]
    counted = named.groupingSets(sets, "month", *_COLUMNS).agg(
        F.grouping_id("month", *_COLUMNS).alias("absent"), F.count(F.lit(1)).alias("n"))
    return counted.select("month", _grouping_name().alias("grouping"), *_COLUMNS, "n")


def _grouping_name() -> Column:
    """The grouping's name by the columns that are absent from it: a bit for
    each, the first column's the highest."""
    names = {sum(1 << (len(_COLUMNS) - 1 - i) for i, c in enumerate(_COLUMNS) if c not in cols): name
             for name, cols in GROUPINGS.items()}
    name = F.lit(None).cast("string")
    for absent, grouping in names.items():
        name = F.when(F.col("absent") == absent, F.lit(grouping)).otherwise(name)
    return name


def write(spark: SparkSession, fact: DataFrame, folder: str) -> None:
    """Write the counts of a load's fact beside it, a partition a month."""
    files.write_table(count_months(fact), f"{folder}/{published.COUNTS}", ["month"])


def read(spark: SparkSession, out: str) -> DataFrame:
    """``month`` and the counts of the star published at ``out``, all of one
    version; months without stored counts are counted from their rows."""
    out = out.rstrip("/")
    manifest = published.current(spark, out)
    if manifest is None:
        raise FileNotFoundError(f"{out}: no star is published here")
    folders = {m: published.counts_folder(f"{out}/{f}") for m, f in manifest["months"].items()}
    stored = {m: p for m, p in folders.items() if files.exists(spark, p)}
    schema = T.StructType([T.StructField("month", T.StringType()), *SCHEMA.fields])
    counts = spark.createDataFrame([], schema)
    if stored:
        scan = spark.read.schema(SCHEMA).parquet(*stored.values())
        month = F.regexp_extract(F.col("_metadata.file_path"), r"/month=([^/]+)/[^/]*$", 1)
        counts = scan.select(month.alias("month"), *SCHEMA.fieldNames())
    bare = {m: f"{out}/{manifest['months'][m]}" for m in folders.keys() - stored.keys()}
    return counts.unionByName(count_months(published.read_fact_months(spark, bare))) if bare else counts


def _of(counts: DataFrame, grouping: str) -> DataFrame:
    return counts.filter(F.col("grouping") == grouping)


def oldest(counts: DataFrame) -> DataFrame:
    """``analytics.oldest`` from counts."""
    return _of(counts, "age").select("age").orderBy(F.desc_nulls_last("age")).limit(1)


def port_types(counts: DataFrame, dim_ports: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``analytics.port_types`` from counts."""
    pre = _of(counts, "port").groupBy("city", "landing_port").agg(F.sum("n").alias("n"))
    p = dim_ports.select(F.col("city").alias("p_city"), "iata_code", "type")
    j = join_dimension(pre, p, (pre["city"] == p["p_city"]) & (pre["landing_port"] == p["iata_code"]), "inner", max_rows)
    return (j.groupBy(F.col("type").alias("port_type")).agg(F.sum("n").alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_last("port_type")))


def top_cities(counts: DataFrame, k: int = 5) -> DataFrame:
    """``analytics.top_cities`` from counts."""
    return (_of(counts, "port").groupBy("city").agg(F.sum("n").alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last("city")).limit(k))


def weekday_counts(counts: DataFrame, dim_time: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``analytics.weekday_counts`` from counts."""
    pre = _of(counts, "day").groupBy("arrival_date").agg(F.sum("n").alias("n"))
    t = dim_time.select("sas_timestamp", "weekday")
    j = join_dimension(pre, t, pre["arrival_date"] == t["sas_timestamp"], "inner", max_rows)
    return (j.groupBy(F.col("weekday").alias("arrival_day")).agg(F.sum("n").alias("count")).orderBy("arrival_day"))


def profile(counts: DataFrame, cols: list[str]) -> DataFrame:
    """``profile.profile`` from counts, for columns that are a grouping alone."""
    unknown = [c for c in cols if GROUPINGS.get(c) != [c]]
    if unknown:
        raise ValueError(f"no counts are kept of {', '.join(unknown)}")
    value = F.coalesce(*[F.col(c).cast("string") for c in cols])  # the other columns are null
    return (counts.filter(F.col("grouping").isin(cols)).groupBy(F.col("grouping").alias("column_name"), value.alias("value"))
            .agg(F.sum("n").alias("count")))


def rows_by_month(counts: DataFrame) -> DataFrame:
    """``month, rows`` of the fact."""
    return _of(counts, "day").groupBy("month").agg(F.sum("n").alias("rows"))
