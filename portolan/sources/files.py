"""File sources and sinks: CSV, Parquet, monthly partitioned datasets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the token the source CSV files use for a missing value.
NULL_TOKEN = "NULL"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             sep: str = ",", null_token: str = NULL_TOKEN, malformed: str = "fail", **options) -> DataFrame:
    """Header CSV, its columns taken by header name and typed by ``schema``.

    ``NULL`` and an empty unquoted field read as null; a quoted empty
    field reads as an empty string. The header of the first file gives the
    columns' places; a column of the schema that it lacks is an error, and so
    is a further file with another header. Columns beyond the schema are not
    read. A value that its type can't hold fails the read, naming column and
    value (``malformed="fail"``), or becomes null (``"null"``); count those
    with ``malformed_values``. Without a schema, types are inferred, which
    costs an extra pass (exploration only).
    """
    if malformed not in ("fail", "null"):
        raise ValueError(f"malformed must be fail or null, not {malformed!r}")
    if schema is None:
        return (spark.read.options(header=True, sep=sep, nullValue=null_token, inferSchema=True, **options).csv(path))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    texts = _csv_texts(spark, path, schema, sep, null_token, options)
    typed = []
    for f in schema.fields:
        raw, value = F.col(f"`{f.name}`"), _typed(f)
        if malformed == "fail" and not isinstance(f.dataType, T.StringType):
            bad = F.raise_error(F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), raw))
            value = F.when(raw.isNull() | value.isNotNull(), value).otherwise(bad.cast(f.dataType))
        typed.append(value.alias(f.name))
    rest = [F.col(f"`{c}`") for c in texts.columns if c not in schema.fieldNames()]  # partition columns
    return texts.select(*typed, *rest)


def malformed_values(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",",
                     null_token: str = NULL_TOKEN) -> DataFrame:
    """``column_name, rows``: how many values of each column its type can't
    hold, in one pass."""
    texts = _csv_texts(spark, path, schema, sep, null_token, {})
    counts = texts.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & _typed(f).isNull()).alias(f.name)
                         for f in schema.fields])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("rows")) for f in schema.fields
    ])).alias("c")).select("c.*")


def _typed(field: T.StructField) -> Column:
    raw = F.col(f"`{field.name}`")
    return raw if isinstance(field.dataType, T.StringType) else raw.try_cast(field.dataType)


def _csv_texts(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str, null_token: str,
               options: dict) -> DataFrame:
    """The schema's columns as text, bound by header name, and any partition
    columns of the path."""
    reader = lambda: spark.read.options(header=True, sep=sep, nullValue=null_token, **options)
    first = reader().csv(path)
    missing = [c for c in schema.fieldNames() if c not in first.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    # Partition columns come last and aren't in the files' headers.
    folders = [c for c in first.columns if c not in schema.fieldNames() and c in _partition_names(first)]
    header = T.StructType([T.StructField(c, T.StringType()) for c in first.columns if c not in folders])
    texts = reader().option("enforceSchema", False).schema(header).csv(path)
    return texts.select(*[F.col(f"`{c}`") for c in [*schema.fieldNames(), *folders]])


def _partition_names(df: DataFrame) -> set[str]:
    """``name=value`` folder names on the way to a frame's files."""
    return {part.split("=")[0] for f in df.inputFiles()[:1] for part in f.split("/") if "=" in part}


def write_csv(df: DataFrame, path: str, sep: str = ",", null_token: str = NULL_TOKEN,
              mode: str = "overwrite") -> None:
    """Header CSV; nulls written as ``NULL``, empty strings as ``""``."""
    (df.write.mode(mode).option("header", True).option("sep", sep)
     .option("nullValue", null_token).csv(path))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> DataFrame:
    """Write Parquet and return the written table read back.

    ``overwrite`` with ``partition_by`` replaces only the partitions present
    in ``df`` (dynamic overwrite), so re-loading a month is idempotent and
    other months stay. ``errorifexists`` and ``append`` are the other modes.

    A partitioned write is preceded by a ``rebalance`` on the partition
    columns: AQE gathers each partition value's rows into few tasks (few
    files per month instead of one per task and month) and splits a value
    holding a large share of the rows into advisory-sized tasks.
    """
    return write_observed(df, path, {}, partition_by, mode)[0]


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column],
                   partition_by: list[str] | None = None,
                   mode: str = "overwrite") -> tuple[DataFrame, dict]:
    """``write_table`` that also returns aggregate ``metrics`` (name -> Column,
    e.g. a row count) of the rows written, measured by the write job itself:
    no second pass over the data.

    The metrics sit directly below the write, above any rebalance, so they
    are computed in the job's final stage. Spark merges a final-stage
    task's metrics once per partition, so retried or speculative tasks are
    not counted twice.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = None
    out = df
    if metrics:
        obs = Observation()
        out = df.observe(obs, *[c.alias(n) for n, c in metrics.items()])
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Read back with the written schema: no footer-reading inference job, and
    # partition values keep the written types instead of inferred ones.
    part_schema = T.StructType([df.schema[c] for c in partition_by or []])
    data_schema = T.StructType([f for f in df.schema.fields if f.name not in (partition_by or [])])
    back = df.sparkSession.read.schema(T.StructType(data_schema.fields + part_schema.fields)).parquet(path)
    return back, (dict(obs.get) if obs is not None else {})


def read_months(spark: SparkSession, base: str, months: list[str] | None = None,
                schema: T.StructType | None = None, column: str = "month") -> DataFrame:
    """Read a ``month=``-partitioned dataset, optionally only some months.

    Only the folders of the months named are listed and scanned, in one job;
    a month without a folder has no rows. With a schema no footer is read to
    infer one.
    """
    if schema is not None and column not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(column, T.StringType())])
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if months is None:
        return reader.parquet(base)
    paths = [p for p in month_paths(base, months, column) if exists(spark, p)]
    if not paths:
        if schema is None:
            raise ValueError(f"{base} has none of the months named")
        return spark.createDataFrame([], schema)
    return reader.option("basePath", base).parquet(*paths)


def month_paths(base: str, months: list[str], column: str = "month") -> list[str]:
    """The path of each month: by the template if ``base`` has ``{month}`` in
    it, else its partition folder."""
    if "{month}" in base:
        return [base.format(month=m) for m in months]
    return [f"{base.rstrip('/')}/{column}={m}" for m in months]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def read_month_files(spark: SparkSession, template: str, months: list[str],
                     schema: T.StructType | None = None, fmt: str = "parquet",
                     column: str = "month", **options) -> DataFrame:
    """Read one file (or folder) per month whose path has the month in its
    name, e.g. ``.../i94_{month}16_sub.parquet`` with months
    ``["jan", "feb", "mar"]``. All months are one scan, their month a column
    taken from the file's path; only the named files are listed, and a month
    without one has no rows."""
    if not months:
        raise ValueError("name at least one month for a templated path")
    paths = [p for p in (template.format(month=m) for m in months) if exists(spark, p)]
    if not paths:
        if schema is None:
            raise ValueError(f"{template} has none of the months named")
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(column, T.StringType())]))
    if fmt == "csv":
        raw = read_csv(spark, paths, schema, **options)
    else:
        reader = spark.read.format(fmt).options(**options)
        raw = (reader.schema(schema) if schema is not None else reader).load(paths)
    # The scan is one; a file's path says its month.
    return raw.withColumn(column, F.regexp_extract(F.col("_metadata.file_path"), _month_pattern(spark, template), 1))


def _month_pattern(spark: SparkSession, template: str) -> str:
    """A pattern that takes the month out of a file's path; the file system
    in front of the path may be spelled in any way."""
    mark = "portolan0month"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(template.format(month=mark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before, after = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getRawPath().split(mark, 1)
    return f"^(?:[^:/]+:(?://[^/]*)?)?{re.escape(before)}([^/]*?){re.escape(after).replace(mark, chr(92) + '1')}(?:/.*)?$"


def stage_monthly(df: DataFrame, base: str, month_col: F.Column, column: str = "month") -> DataFrame:
    """Write a frame as one partition per month (dynamic overwrite) and read it back."""
    return write_table(df.withColumn(column, month_col), base, partition_by=[column])
