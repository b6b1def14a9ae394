import re

import pytest
from conftest import SF_SMALL

from portolan.functions.dates import month_key
from portolan.plans import job
from portolan.plans.registry import sources, star
from portolan.sources import files, published, warehouse


SCALED = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
          "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The derived sources written as the raw file kinds the job reads."""
    base = str(tmp_path_factory.mktemp("etl_in"))
    src = sources(spark, SF_SMALL)
    files.stage_monthly(src.arrivals, f"{base}/arrivals", month_key("arrdate"))
    src.arrivals.withColumn("month", month_key("arrdate")).write.partitionBy("month") \
        .option("header", True).option("nullValue", files.NULL_TOKEN).csv(f"{base}/arrivals_csv")
    files.write_csv(src.cities, f"{base}/cities", sep=";")
    files.write_csv(src.ports, f"{base}/ports", sep=",")
    files.write_csv(src.temperatures, f"{base}/temperatures", sep=",")
    return base


def _args(base, out, *extra):
    return ["--arrivals", f"{base}/arrivals", "--cities", f"{base}/cities", "--ports", f"{base}/ports",
            "--temperatures", f"{base}/temperatures", "--out", out, *extra]


def test_cli_writes_a_checked_star(spark, staged, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert job.main(_args(staged, out, "--no-autoscale")) == 0
    printed = capsys.readouterr().out
    assert printed.count("PASS") == 10 and "FAIL" not in printed
    fact = published.read(spark, out)["fact_immigrations"]
    expected = star(spark, SF_SMALL)["fact_immigrations"]
    assert sorted(fact.collect()) == sorted(expected.collect())


def test_only_the_named_months_are_listed(spark, staged, tmp_path):
    months = ["1995-03", "1996-07"]
    for folder, fmt in (("arrivals", "parquet"), ("arrivals_csv", "csv")):
        src = job.read_sources(spark, f"{staged}/{folder}", f"{staged}/cities", f"{staged}/ports",
                               f"{staged}/temperatures", months, fmt)
        assert {re.search("month=([0-9-]+)", f)[1] for f in src.arrivals.inputFiles()} == set(months)
    src = job.read_sources(spark, f"{staged}/arrivals", f"{staged}/cities", f"{staged}/ports",
                           f"{staged}/temperatures", months)
    tables, report = job.run(spark, src, str(tmp_path / "out"), raise_on_failure=False)
    got = {r.m for r in tables["fact_immigrations"].select(month_key("arrival_date").alias("m")).distinct().collect()}
    assert got and got <= set(months)


def test_csv_arrivals_read_like_parquet(spark, staged):
    a = job.read_sources(spark, f"{staged}/arrivals_csv", f"{staged}/cities", f"{staged}/ports",
                              f"{staged}/temperatures", arrivals_format="csv").arrivals
    b = job.read_sources(spark, f"{staged}/arrivals", f"{staged}/cities", f"{staged}/ports",
                              f"{staged}/temperatures").arrivals
    assert a.schema == b.schema
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unknown_arrivals_format_is_refused(spark, staged):
    with pytest.raises(ValueError):
        job.read_sources(spark, staged, staged, staged, staged, arrivals_format="sas7bdat")


def test_cli_with_a_template_and_autoscale(spark, staged, tmp_path, capsys):
    before = {k: spark.conf.get(k, None) for k in SCALED}
    try:
        args = _args(staged, str(tmp_path / "out"), "--months", "1995-03", "1996-07")
        args[1] = f"{staged}/arrivals/month={{month}}"
        assert job.main(args) == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    printed = capsys.readouterr().out
    assert "FAIL" not in printed and "without_port 1995-03" in printed and "unique_key" in printed


def test_failing_load_changes_nothing_and_a_new_month_joins_the_old(spark, staged, tmp_path):
    paths = (f"{staged}/cities", f"{staged}/ports", f"{staged}/temperatures")
    out = str(tmp_path / "out")
    first, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *paths, ["1995-03"]), out, "portolan_job_t")
    stored = sorted(first["fact_immigrations"].collect())
    assert stored
    empty = job.read_sources(spark, f"{staged}/arrivals", f"{staged}/cities", f"{staged}/ports", f"{staged}/temperatures", ["1996-07"])
    empty.ports = empty.ports.limit(0)
    with pytest.raises(AssertionError, match="dim_ports.row_count"):
        job.run(spark, empty, out)
    now = published.read(spark, out)
    assert sorted(now["fact_immigrations"].collect()) == stored and now["dim_ports"].count() > 0
    both, report = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *paths, ["1996-07"]), out, "portolan_job_t")
    rep = {(r.table_name, r.check_name): r.observed for r in report.collect()}
    n = both["fact_immigrations"].count()
    assert rep["fact_immigrations", "row_count"] == n == len(stored) + rep["fact_immigrations", "rows_written"]
    assert spark.table("portolan_job_t.fact_immigrations").count() == n
    days = {r[0] for r in both["fact_immigrations"].select("arrival_date").distinct().collect()}
    assert days <= {r[0] for r in both["dim_time"].select("sas_timestamp").collect()}
    again, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *paths, ["1996-07"]), out)
    assert again["fact_immigrations"].count() == n


def test_failed_checks_raise(spark, staged, tmp_path):
    src = job.read_sources(spark, f"{staged}/arrivals", f"{staged}/cities", f"{staged}/ports",
                                f"{staged}/temperatures", ["1800-01"])  # no such month: empty fact
    with pytest.raises(AssertionError, match="fact_immigrations.row_count"):
        job.run(spark, src, str(tmp_path / "out"))


def test_scale_settings_from_input_bytes_keep_launch_values(spark, staged):
    import os

    from portolan.session import apply_scale, path_bytes

    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{staged}/ports")
                  for f in fs if not f.startswith("."))             # checksum files are hidden
    assert path_bytes(spark, [f"{staged}/ports"]) == on_disk
    before = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        applied = apply_scale(spark, 10 << 40)                    # 10 TiB of input
        assert "spark.sql.shuffle.partitions" not in applied         # set at launch: kept
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert applied["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
        assert "spark.decommission.enabled" not in applied           # not changeable at runtime
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        for k in ("spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)


def test_templated_month_files_read_like_the_partitioned_dataset(spark, staged):
    months = ["1995-03", "1996-07", "1997-11"]
    paths = (f"{staged}/cities", f"{staged}/ports", f"{staged}/temperatures")
    templated = job.read_sources(spark, f"{staged}/arrivals/month={{month}}", *paths, months).arrivals
    partitioned = job.read_sources(spark, f"{staged}/arrivals", *paths, months).arrivals
    assert templated.count() > 0
    assert templated.exceptAll(partitioned).count() == 0 and partitioned.exceptAll(templated).count() == 0
    tagged = files.read_month_files(spark, f"{staged}/arrivals/month={{month}}", months)
    assert {r.month for r in tagged.select("month").distinct().collect()} == set(months)
    with pytest.raises(ValueError):
        files.read_month_files(spark, f"{staged}/arrivals/month={{month}}", [])


def test_templated_csv_month_files(spark, staged):
    months = ["1995-03", "1996-07"]
    paths = (f"{staged}/cities", f"{staged}/ports", f"{staged}/temperatures")
    csv = job.read_sources(spark, f"{staged}/arrivals_csv/month={{month}}", *paths, months,
                           arrivals_format="csv").arrivals
    parquet = job.read_sources(spark, f"{staged}/arrivals", *paths, months).arrivals
    assert csv.count() > 0
    assert csv.exceptAll(parquet).count() == 0 and parquet.exceptAll(csv).count() == 0


def _paths(base):
    return f"{base}/cities", f"{base}/ports", f"{base}/temperatures"


def test_a_crash_while_publishing_leaves_the_old_star_whole(spark, staged, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    first, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1995-03"]), out)
    stored = {name: sorted(df.collect(), key=str) for name, df in first.items()}

    def crash(*_):
        raise OSError("the driver is gone")

    for step in ("_write_once", "publish"):
        with monkeypatch.context() as m:
            m.setattr(published, step, crash)
            with pytest.raises(OSError, match="is gone"):
                job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1996-07"]), out)
        assert {name: sorted(df.collect(), key=str) for name, df in published.read(spark, out).items()} == stored
    both, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1996-07"]), out)
    assert both["fact_immigrations"].count() > len(stored["fact_immigrations"])


def test_readers_of_the_last_version_are_not_disturbed_and_older_ones_go(spark, staged, tmp_path):
    out = str(tmp_path / "out")
    read = []
    for month in ("1995-03", "1996-07", "1995-03", "1995-03"):
        job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), [month]), out)
        read.append(published.read(spark, out))
        for star_then in read[-published.KEEP:]:  # frames of the version before still run
            assert all(df.count() > 0 for df in star_then.values())
    assert len(published.names_in(spark, f"{out}/_published")) == published.KEEP
    named = {p.split("/")[1] for p in (m for f in [published.current(spark, out)] for m in f["months"].values())}
    assert named <= set(published.names_in(spark, f"{out}/versions")) and len(published.names_in(spark, f"{out}/versions")) == 3


def test_a_version_is_written_once(spark, tmp_path):
    path = str(tmp_path / "_published" / "000000000001.json")
    published._write_once(spark, path, "{}")
    with pytest.raises(FileExistsError):
        published._write_once(spark, path, "{}")
    assert open(path).read() == "{}"
    with pytest.raises(FileNotFoundError):
        published.read(spark, str(tmp_path / "nothing"))


def test_a_reloaded_month_without_matches_is_replaced_by_nothing(spark, staged, tmp_path):
    out, db = str(tmp_path / "out"), "portolan_job_gone"
    months = ["1995-03", "1996-07"]
    src = job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), months)
    first, _ = job.run(spark, src, out, db)
    by_month = lambda t: {r[0]: r[1] for r in t["fact_immigrations"].groupBy(month_key("arrival_date")).count().collect()}
    before = by_month(first)
    assert set(before) == set(months)
    # The month's arrivals come again, all at ports that nobody knows.
    lost = job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1996-07"])
    lost.arrivals = lost.arrivals.withColumn("i94port", month_key("arrdate"))
    second, report = job.run(spark, lost, out, db)
    assert by_month(second) == {"1995-03": before["1995-03"]}
    assert spark.table(f"{db}.fact_immigrations").where("month = '1996-07'").count() == 0
    assert spark.table(f"{db}.fact_immigrations").count() == before["1995-03"]
    days = {r[0] for r in second["dim_time"].select("sas_timestamp").collect()}
    held = second["fact_immigrations"]
    assert days == {r[0] for c in ("arrival_date", "departure_date") for r in held.select(c).collect()}
    said = {r.check_name: (r.observed, r.passed) for r in report.collect() if r.check_name.startswith("without_port")}
    assert said.keys() == {"without_port 1996-07"} and said["without_port 1996-07"][0] > 0 and not said["without_port 1996-07"][1]
    # It comes back, and then its folder is empty: only the list of months says that it was loaded.
    third, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1996-07"]), out, db)
    assert by_month(third) == before and spark.table(f"{db}.fact_immigrations").count() == sum(before.values())
    gone = job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), ["1996-07"])
    gone.arrivals = gone.arrivals.limit(0)
    fourth, _ = job.run(spark, gone, out, db, raise_on_failure=False, months=["1996-07"])
    assert by_month(fourth) == {"1995-03": before["1995-03"]}


def test_a_table_of_another_folder_is_not_kept(spark, staged, tmp_path):
    db = "portolan_job_moved"
    for month in ("1995-03", "1996-07"):
        out = str(tmp_path / month)
        tables, _ = job.run(spark, job.read_sources(spark, f"{staged}/arrivals", *_paths(staged), [month]), out, db)
        assert spark.table(f"{db}.fact_immigrations").count() == tables["fact_immigrations"].count()
        read = warehouse.read_tables(spark, db)
        assert sorted(read["dim_time"].collect()) == sorted(tables["dim_time"].collect())


def test_templated_months_are_one_scan(spark, staged):
    months = ["1995-03", "1900-01", "1996-07"]
    for folder, fmt in (("arrivals", "parquet"), ("arrivals_csv", "csv")):
        df = files.read_month_files(spark, f"{staged}/{folder}/month={{month}}", months, job.ARRIVALS_RAW, fmt=fmt)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan
        got = {r["month"]: r["count"] for r in df.groupBy("month").count().collect()}
        assert got.keys() == {"1995-03", "1996-07"}  # the month without a file has no rows
        assert all(df.where(f"month = '{m}'").count() == n == spark.read.parquet(f"{staged}/arrivals/month={m}").count()
                   for m, n in got.items())
    assert files.read_month_files(spark, f"{staged}/nothing/{{month}}", ["x"], job.ARRIVALS_RAW).count() == 0
    with pytest.raises(ValueError, match="none of the months"):
        files.read_month_files(spark, f"{staged}/nothing/{{month}}", ["x"])


def test_month_is_taken_from_odd_paths(spark, tmp_path):
    for month in ("jan", "feb"):
        spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/in dir.{month}+/i94 {month}16_sub.parquet")
    df = files.read_month_files(spark, f"{tmp_path}/in dir.{{month}}+/i94 {{month}}16_sub.parquet", ["jan", "feb"])
    assert {r["month"]: r["count"] for r in df.groupBy("month").count().collect()} == {"jan": 3, "feb": 3}
