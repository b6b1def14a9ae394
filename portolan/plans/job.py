"""The batch job: raw source files in, checked star schema out.

    python -m portolan.plans.job --arrivals BASE --cities PATH --ports PATH \\
        --temperatures PATH --out BASE [--months 2016-01 2016-02 ...] \\
        [--arrivals-format parquet|csv] [--database NAME] [--no-raise] [--no-autoscale]

Arrivals are a ``month=``-partitioned dataset of the 28 raw columns
(Parquet, or header CSV, columns bound by header name); with ``--months``
only those folders are listed and read, all in one job. A path with
``{month}`` in it names one file or folder per month instead (the month
list is then required). Cities are a
``;``-separated header CSV, ports and temperatures comma-separated; all
are read with fixed schemas (no inference pass). The star is written into a
folder of its own under ``--out``, checked as a whole, and then published
there, all tables at once (``sources.published``), and as external tables of
``--database``; a load that fails a required check changes nothing. The session comes from the cluster (``spark-submit``
settings); nothing here picks a master or a local folder. Unless
``--no-autoscale`` is given, shuffle partitions, split and skew sizes are
set from the bytes under the source paths (``session.apply_scale``);
settings given at launch are kept.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions.dates import month_key
from portolan.operators import dims, fact, quality
from portolan.plans import monthly_counts
from portolan.plans.star import Sources, load_star_observed
from portolan.schemas import ARRIVALS_RAW, CITIES_RAW, DIM_TIME, PORTS_RAW, TEMPERATURES_RAW
from portolan.sources import files, published, warehouse


def read_sources(spark: SparkSession, arrivals: str, cities: str, ports: str, temperatures: str,
                 months: list[str] | None = None, arrivals_format: str = "parquet") -> Sources:
    """The four raw sources, typed by their fixed schemas.

    ``arrivals`` is a ``month=``-partitioned dataset, or a path template with
    ``{month}`` in it (one file or folder per month, e.g.
    ``.../i94_{month}16_sub.parquet``), which then needs ``months``.
    """
    if "{month}" in arrivals:
        if arrivals_format not in ("parquet", "csv"):
            raise ValueError(f"arrivals format must be parquet or csv, not {arrivals_format!r}")
        raw = files.read_month_files(spark, arrivals, months or [], ARRIVALS_RAW, fmt=arrivals_format)
    elif arrivals_format == "parquet":
        raw = files.read_months(spark, arrivals, months, ARRIVALS_RAW)
    elif arrivals_format == "csv":
        paths = arrivals if months is None else [p for p in files.month_paths(arrivals, months) if files.exists(spark, p)]
        raw = (files.read_csv(spark, paths, ARRIVALS_RAW, basePath=arrivals) if paths
               else spark.createDataFrame([], ARRIVALS_RAW))
    else:
        raise ValueError(f"arrivals format must be parquet or csv, not {arrivals_format!r}")
    return Sources(
        arrivals=raw.select(*[F.col(f.name).cast(f.dataType) for f in ARRIVALS_RAW.fields]),
        cities=files.read_csv(spark, cities, CITIES_RAW, sep=";"),
        ports=files.read_csv(spark, ports, PORTS_RAW, sep=","),
        temperatures=files.read_csv(spark, temperatures, TEMPERATURES_RAW, sep=","),
    )


# Checks that a load must pass to be published; the others inform.
REQUIRED = ("row_count", "null_key")


def run(spark: SparkSession, src: Sources, out: str, database: str | None = None,
        raise_on_failure: bool = True, months: list[str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load the star into a folder of its own below ``out``, check the tables
    as they will be, and only then publish them, all at once, as the star at
    ``out`` (``published.read``) and as external tables of ``database`` when
    given.

    The months that this run loads replace those stored before, also where
    none of their rows reach the fact: they are the calendar months of the
    raw arrivals, and those in ``months`` (as ``yyyy-mm``) whether they have
    rows or not. Other months stay, and count in the checks and in the time
    dimension. The report has, per table, the rows this run wrote, row count,
    null keys and repeated keys of the whole table, and the cleaned arrivals
    of this run that have no port, by month. The months that the run wrote are
    counted for the analytic queries (``monthly_counts``). If a required check fails, the
    published star stays as it was, what was written stays in its folder
    under ``out/versions`` to be looked at, and the run raises (or returns
    the tables of that folder).
    """
    out = out.rstrip("/")
    folder = published.new_folder(out)
    tables, metrics = load_star_observed(spark, src, folder)
    written = tables["fact_immigrations"]
    monthly_counts.write(spark, written, folder)
    # One row for each calendar month, from one column of the raw arrivals.
    seen = src.arrivals.select(month_key("arrdate").alias("month")).distinct().collect()
    loaded = {r["month"] for r in seen} | set(months or [])
    fact_months = published.months_after(spark, out, folder, loaded)
    if len(fact_months) > len(published.months_in(spark, f"{folder}/fact_immigrations")):
        tables["fact_immigrations"] = published.read_fact_months(spark, fact_months)
        files.write_table(dims.dim_time(tables["fact_immigrations"]), f"{folder}/dim_time")
        tables["dim_time"] = spark.read.schema(DIM_TIME).parquet(f"{folder}/dim_time")
    report = _report(spark, src, tables, metrics, written)
    failed = report.filter(F.col("check_name").isin(*REQUIRED) & ~F.col("passed"))
    if not failed.isEmpty():
        if raise_on_failure:
            quality.raise_on_failure(failed)
        return tables, report
    published.publish(spark, out, folder, fact_months)
    if database:
        warehouse.register_published(spark, out, database)
    return published.read(spark, out), report


def _report(spark: SparkSession, src: Sources, tables: dict[str, DataFrame], metrics: dict[str, dict],
            written: DataFrame) -> DataFrame:
    """The checks of a load, worked out now: a few rows per table, and one
    for each calendar month."""
    rows = [(name, "rows_written", None, int(m["row_count"]), True) for name, m in metrics.items()]
    checks = [tuple(r) for r in quality.quality_report(tables).collect()]
    loss = fact.match_loss(src.arrivals, tables["dim_ports"], written)
    lost = [("fact_immigrations", f"without_port {r['month']}", None, r["rows_lost"], r["rows_matched"] > 0)
            for r in loss.orderBy("month").collect()]
    return spark.createDataFrame(rows + checks + lost, quality.REPORT_SCHEMA)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m portolan.plans.job", description=__doc__.split("\n")[0])
    ap.add_argument("--arrivals", required=True)
    ap.add_argument("--cities", required=True)
    ap.add_argument("--ports", required=True)
    ap.add_argument("--temperatures", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--months", nargs="*")
    ap.add_argument("--arrivals-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--database")
    ap.add_argument("--no-raise", action="store_true")
    ap.add_argument("--no-autoscale", action="store_true",
                    help="keep the session's shuffle and split sizes instead of sizing them from the input")
    a = ap.parse_args(argv)

    from portolan.session import apply_scale, build_session, path_bytes
    spark = build_session(app="portolan-job")
    if not a.no_autoscale:
        # Shuffle partitions, split and skew sizes from the input volume.
        arrivals = files.month_paths(a.arrivals, a.months) if a.months else [a.arrivals]
        arrivals = [p for p in arrivals if files.exists(spark, p)]
        apply_scale(spark, path_bytes(spark, [*arrivals, a.cities, a.ports, a.temperatures]))
    src = read_sources(spark, a.arrivals, a.cities, a.ports, a.temperatures, a.months, a.arrivals_format)
    _, report = run(spark, src, a.out, a.database, raise_on_failure=False, months=a.months)
    rows = report.collect()  # one small row per table and check
    for r in rows:
        said = ("PASS" if r.passed else "FAIL") if r.check_name in REQUIRED else "info"
        print(f"{r.table_name:18} {r.check_name:20} {r.observed:>14} {said}")
    return 0 if a.no_raise or all(r.passed for r in rows if r.check_name in REQUIRED) else 1


if __name__ == "__main__":
    sys.exit(main())
