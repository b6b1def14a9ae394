"""Warehouse tables in the Spark catalog: DDL and load.

``register_tables`` puts the star's Parquet folders, as a load wrote them,
into the catalog: external tables typed as in the schema constants, the fact
partitioned by month, and no second copy. ``create_tables`` and
``load_tables`` are for frames that aren't written yet: tables of the
catalog's own (``CREATE TABLE IF NOT EXISTS``), loaded by position after a
cast to the table types; loading overwrites, so running it twice leaves the
same rows. Declared keys are not enforced by the table format; ``quality``
checks them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.schemas import STAR_TABLES
from portolan.session import run_concurrently
from portolan.sources import published


# Tables whose Parquet folders have a partition column beside the schema.
PARTITIONED = {"fact_immigrations": "month"}


# What the warehouse deals a table's rows by: rows with one key lie together.
DISTRIBUTION = {"fact_immigrations": "city", "dim_cities": "city", "dim_temperatures": "city", "dim_ports": "port_id"}


def table_ddl(database: str, name: str, location: str | None = None, buckets: int | None = None) -> str:
    """The table's DDL; with a location, of the external table on that
    folder; with ``buckets``, dealt into so many by its distribution key."""
    schema, _ = STAR_TABLES[name]
    cols = [f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields]
    rest = ""
    if buckets and name in DISTRIBUTION:
        key = DISTRIBUTION[name]
        rest += f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    if location is not None:
        if name in PARTITIONED:
            cols.append(f"`{PARTITIONED[name]}` STRING")
            rest += f" PARTITIONED BY (`{PARTITIONED[name]}`)"
        rest += f" LOCATION '{location}'"
    return f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({', '.join(cols)}) USING parquet{rest}"


def register_tables(spark: SparkSession, base: str, database: str) -> None:
    """External tables of ``database`` on the folders ``{base}/{name}``. Safe
    to repeat: partitions and files that a later load brought are found."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in STAR_TABLES:
        _external(spark, database, name, f"{base}/{name}")
        if name in PARTITIONED:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
        spark.catalog.refreshTable(f"`{database}`.`{name}`")


def _external(spark: SparkSession, database: str, name: str, location: str) -> None:
    """The external table on a folder; one that lies elsewhere is made anew
    (its files stay)."""
    table = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(table):
        described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
        path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
        if described is None or path(described["data_type"]) != path(location):
            spark.sql(f"DROP TABLE {table}")
    spark.sql(table_ddl(database, name, location))


def register_published(spark: SparkSession, out: str, database: str) -> None:
    """External tables of ``database`` on the version published at ``out``:
    each table on its folder, the fact with a partition for each month, at
    that month's folder. Safe to repeat; run it after each load."""
    manifest = published.current(spark, out)
    if manifest is None:
        raise FileNotFoundError(f"{out}: no star is published here")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, folder in manifest["tables"].items():
        _external(spark, database, name, f"{out}/{folder}")
        spark.catalog.refreshTable(f"`{database}`.`{name}`")
    fact, column = f"`{database}`.`{published.FACT}`", PARTITIONED[published.FACT]
    _external(spark, database, published.FACT, f"{out}/versions")
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {fact}").collect()}
    for month in sorted(known - manifest["months"].keys()):
        spark.sql(f"ALTER TABLE {fact} DROP PARTITION ({column} = '{month}')")
    for month, folder in manifest["months"].items():
        verb, place = ("", "SET") if month in known else ("ADD", "")
        spark.sql(f"ALTER TABLE {fact} {verb} PARTITION ({column} = '{month}') {place} LOCATION '{out}/{folder}'")
    spark.catalog.refreshTable(fact)


def create_tables(spark: SparkSession, database: str, location: str | None = None, buckets: int | None = None) -> None:
    """Create the database (optionally at ``location``) and the five tables;
    with ``buckets``, dealt into so many by their distribution keys, so that
    joins and groupings by city need no shuffle of the fact."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    for name in STAR_TABLES:
        spark.sql(table_ddl(database, name, buckets=buckets))


def load_tables(frames: Mapping[str, DataFrame], database: str, buckets: int | None = None) -> None:
    """Overwrite each table with its frame, cast to the table's column types.

    The tables are independent, so their loads run at the same time. With
    ``buckets``, as the tables were created, a bucket's rows are gathered in
    as many tasks as the session's shuffle partitions allow for it, so a
    bucket has few files, and a key that holds a large share of the rows is
    written by several tasks (a bucketed read takes a bucket in one).
    """
    def load(name: str, df: DataFrame):
        schema, _ = STAR_TABLES[name]
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        if buckets and name in DISTRIBUTION:
            tasks = max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            bucket = F.pmod(F.hash(DISTRIBUTION[name]), F.lit(buckets))
            part = F.pmod(F.xxhash64(*schema.fieldNames()), F.lit(-(-tasks // buckets)))
            typed = typed.repartition(tasks, bucket, part)
        return lambda: typed.write.insertInto(f"`{database}`.`{name}`", overwrite=True)

    run_concurrently({name: load(name, df) for name, df in frames.items()})


def read_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables by name, with the columns of their schemas."""
    return {name: spark.table(f"`{database}`.`{name}`").select(*schema.fieldNames())
            for name, (schema, _) in STAR_TABLES.items()}
