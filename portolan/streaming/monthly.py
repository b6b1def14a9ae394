"""Incremental monthly fact load with Structured Streaming.

The batch pipeline loads every month in one job. When raw files keep landing
in a folder, this loader reacts only to files it has not seen (the file
source records them in the checkpoint), and reloads whole months: each
micro-batch notes which months its files hold rows of (``read_file_months``),
reads those months from the landed files that hold them, and replaces their
partitions of the fact; a month that has no fact rows any more loses its
partition. Copies of a row therefore collapse however the rows were split
over files and batches, and the fact equals the batch build of the same rows
at any time. A retried batch rebuilds the same months, so the load is
idempotent.

Landed files must stay; a batch opens only those that hold its months, not
all that ever landed. The time dimension is rebuilt afterwards from the whole fact
(``dims.dim_time(read_fact(...))``). Each batch also records the number of
fact rows it wrote (``read_load_log``), measured by its write job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from portolan.functions.dates import month_key
from portolan.operators.fact import FACT_COLUMNS, fact_from_raw
from portolan.schemas import ARRIVALS_RAW
from portolan.session import remove_path

# Per-batch load log, below the output folder. Spark skips folders whose
# name starts with '_' when the fact is read.
LOAD_LOG = "_load_log"
LOAD_LOG_SCHEMA = T.StructType([T.StructField("batch", T.LongType()),
                                T.StructField("rows_written", T.LongType())])

# Which landed file holds rows of which months, by the batch that first saw it.
FILE_MONTHS = "_file_months"
FILE_MONTHS_SCHEMA = T.StructType([T.StructField("batch", T.LongType()), T.StructField("landed_file", T.StringType()),
                                   T.StructField("month", T.StringType())])


def start_monthly_load(spark: SparkSession, landing_dir: str, ports: DataFrame, out_dir: str,
                       checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Start the loader over raw arrival Parquet files in ``landing_dir``.

    ``ports`` is the port dimension, best a written table; its size is
    checked in every batch, so it may grow while the loader runs. With
    ``available_now`` the query processes what has landed and stops;
    otherwise it keeps running.
    """
    stream = spark.readStream.schema(ARRIVALS_RAW).parquet(landing_dir).withColumn("landed_file", F.col("_metadata.file_path"))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Which months each file holds: one row for each file and month.
        _log(session, batch.withColumn("month", month_key("arrdate")).where("month IS NOT NULL")
             .select("landed_file", "month").distinct().withColumn("batch", F.lit(batch_id)), f"{out_dir}/{FILE_MONTHS}")
        index = _read_log(session, f"{out_dir}/{FILE_MONTHS}", FILE_MONTHS_SCHEMA)
        months = [r["month"] for r in index.where(F.col("batch") == batch_id).select("month").distinct().collect()]
        rows = 0
        if months:
            # Of all that has landed, only files with rows of these months are opened.
            opened = [r[0] for r in index.where(F.col("month").isin(months)).select("landed_file").distinct().collect()]
            raw = (session.read.schema(ARRIVALS_RAW).parquet(*sorted(opened))
                   .withColumn("month", month_key("arrdate")).where(F.col("month").isin(months)))
            written = Observation()
            counts = {f"rows{i}": F.count_if(F.col("month") == m) for i, m in enumerate(months)}
            (fact_from_raw(raw, ports, carry=("month",)).hint("rebalance", "month")
             .observe(written, *[c.alias(name) for name, c in counts.items()])
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(out_dir))
            for name, month in zip(counts, months, strict=True):
                rows += int(written.get[name])
                if not written.get[name]:  # none of its rows has a port any more
                    remove_path(session, f"{out_dir}/month={month}")
        # One log row per batch; a retried batch replaces its own row.
        _log(session, session.createDataFrame([(batch_id, rows)], LOAD_LOG_SCHEMA), f"{out_dir}/{LOAD_LOG}")

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _log(session: SparkSession, rows: DataFrame, path: str) -> None:
    """Write a batch's rows of a log in place of those of a first try."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def _read_log(session: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return session.read.schema(schema).option("basePath", path).parquet(path).select(*schema.fieldNames())


def read_load_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, rows_written) per loaded micro-batch."""
    return _read_log(spark, f"{out_dir}/{LOAD_LOG}", LOAD_LOG_SCHEMA)


def read_file_months(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, landed_file, month): which months each landed file holds."""
    return _read_log(spark, f"{out_dir}/{FILE_MONTHS}", FILE_MONTHS_SCHEMA)


def read_fact(spark: SparkSession, out_dir: str, months: list[str] | None = None) -> DataFrame:
    """The loaded fact table (optionally only some months)."""
    df = spark.read.option("basePath", out_dir).parquet(out_dir)
    if months is not None:
        df = df.filter(F.col("month").cast("string").isin(list(months)))
    return df.select(*FACT_COLUMNS)
