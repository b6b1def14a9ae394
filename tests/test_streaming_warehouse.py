import tempfile

from conftest import SF_SMALL, arrivals, cities, ports

from portolan.operators import clean, dims, fact, quality
from portolan.plans.registry import star
from portolan.sources import warehouse
from portolan.streaming import read_fact, read_file_months, read_load_log, start_monthly_load


def _dim_ports(spark):
    return dims.dim_ports(clean.clean_ports(ports(spark, [{}])), clean.clean_cities(cities(spark, [{}])))


def test_stream_loads_only_new_files_and_is_repeatable(spark):
    root = tempfile.mkdtemp(prefix="portolan-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/fact", f"{root}/ckpt"
    p = _dim_ports(spark)
    arrivals(spark, [{"cicid": 1.0, "arrdate": 20454.0}, {"cicid": 1.0, "arrdate": 20454.0},
                     {"cicid": 2.0, "arrdate": 20460.0}]).write.parquet(f"{landing}/jan")
    q = start_monthly_load(spark, landing + "/*", p, out, ckpt)
    q.awaitTermination()
    assert sorted(r.immigration_id for r in read_fact(spark, out).collect()) == [1, 2]

    arrivals(spark, [{"cicid": 3.0, "arrdate": 20485.0, "depdate": 20490.0}]).write.parquet(f"{landing}/feb")
    start_monthly_load(spark, landing + "/*", p, out, ckpt).awaitTermination()
    start_monthly_load(spark, landing + "/*", p, out, ckpt).awaitTermination()  # nothing new
    fact = read_fact(spark, out)
    assert sorted(r.immigration_id for r in fact.collect()) == [1, 2, 3]
    assert [r.immigration_id for r in read_fact(spark, out, ["2016-02"]).collect()] == [3]
    t = dims.dim_time(fact)
    assert t.count() == t.select("sas_timestamp").distinct().count()
    log = sorted(tuple(r) for r in read_load_log(spark, out).collect())
    assert [b for b, _ in log] == [0, 1] and sum(n for _, n in log) == 3


def test_stream_fact_is_the_same_for_any_landing(spark):
    rows = [{"cicid": float(i % 40), "arrdate": 20454.0 + i % 50, "depdate": 20600.0} for i in range(120)]
    p = _dim_ports(spark)
    want = sorted(fact.fact_from_raw(arrivals(spark, rows), p).collect())
    for split in ([rows], [rows[:50], rows[50:]], [rows, rows[::-1]], [rows[i::5] for i in range(5)]):
        root = tempfile.mkdtemp(prefix="portolan-stream-")
        for i, part in enumerate(split):
            arrivals(spark, part).coalesce(1).write.parquet(f"{root}/landing/part{i}")
            start_monthly_load(spark, f"{root}/landing/*", p, f"{root}/fact", f"{root}/ckpt").awaitTermination()
        assert sorted(read_fact(spark, f"{root}/fact").collect()) == want


def test_a_month_whose_ports_vanish_goes(spark):
    root = tempfile.mkdtemp(prefix="portolan-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/fact", f"{root}/ckpt"
    arrivals(spark, [{"cicid": 1.0, "arrdate": 20454.0}, {"cicid": 2.0, "arrdate": 20485.0}]).write.parquet(f"{landing}/a")
    start_monthly_load(spark, landing + "/*", _dim_ports(spark), out, ckpt).awaitTermination()
    assert sorted(r.immigration_id for r in read_fact(spark, out).collect()) == [1, 2]
    arrivals(spark, [{"cicid": 3.0, "arrdate": 20486.0}]).write.parquet(f"{landing}/b")
    start_monthly_load(spark, landing + "/*", _dim_ports(spark).limit(0), out, ckpt).awaitTermination()
    assert [r.immigration_id for r in read_fact(spark, out).collect()] == [1]  # 2016-02 was reloaded to nothing
    assert sorted(tuple(r) for r in read_load_log(spark, out).collect()) == [(0, 2), (1, 0)]


def test_a_batch_opens_only_the_files_of_its_months(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    root = tempfile.mkdtemp(prefix="portolan-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/fact", f"{root}/ckpt"
    opened, read = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **kw: (opened.append(paths), read(self, *paths, **kw))[1])
    for i, days in enumerate(([20454.0, 20485.0], [20460.0], [20514.0], [20490.0])):  # January, February; January; March; February
        arrivals(spark, [{"cicid": float(10 * i + j), "arrdate": d, "depdate": 20600.0} for j, d in enumerate(days)]) \
            .coalesce(1).write.parquet(f"{landing}/part{i}")
        opened.clear()
        start_monthly_load(spark, landing + "/*", _dim_ports(spark), out, ckpt).awaitTermination()
        files_read = {p.split("/")[-2] for paths in opened for p in paths if landing in p}
        assert files_read == [{"part0"}, {"part0", "part1"}, {"part2"}, {"part0", "part3"}][i]
    assert sorted(r.immigration_id for r in read_fact(spark, out).collect()) == [0, 1, 10, 20, 30]
    index = {(r.batch, r.month) for r in read_file_months(spark, out).collect()}
    assert index == {(0, "2016-01"), (0, "2016-02"), (1, "2016-01"), (2, "2016-03"), (3, "2016-02")}


def test_tables_dealt_by_city_are_joined_where_they_lie(spark):
    from portolan.plans import analytics

    loc, db = tempfile.mkdtemp(prefix="portolan-wh-"), "portolan_test_dealt"
    warehouse.create_tables(spark, db, loc, buckets=4)
    s = star(spark, SF_SMALL)
    frames = {name: s[name] for name in ("fact_immigrations", "dim_cities", "dim_ports")}
    warehouse.load_tables(frames, db, buckets=4)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {db}.dim_ports").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`port_id`]"
    t = warehouse.read_tables(spark, db)
    assert sorted(t["fact_immigrations"].collect()) == sorted(frames["fact_immigrations"].collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = analytics.city_populations(t["fact_immigrations"], t["dim_cities"])
        got = sorted(joined.collect())
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert got and got == sorted(analytics.city_populations(frames["fact_immigrations"], frames["dim_cities"]).collect())


def test_warehouse_create_load_twice(spark):
    loc = tempfile.mkdtemp(prefix="portolan-wh-")
    db = "portolan_test_wh"
    warehouse.create_tables(spark, db, loc)
    warehouse.create_tables(spark, db, loc)            # IF NOT EXISTS
    frames = star(spark, SF_SMALL)
    warehouse.load_tables(frames, db)
    first = {r.table_name: r.observed for r in quality.row_count_check(warehouse.read_tables(spark, db)).collect()}
    warehouse.load_tables(frames, db)
    second = {r.table_name: r.observed for r in quality.row_count_check(warehouse.read_tables(spark, db)).collect()}
    assert first == second and all(v > 0 for v in first.values())
    t = warehouse.read_tables(spark, db)["fact_immigrations"]
    assert dict(t.dtypes)["immigration_id"] == "int" and dict(t.dtypes)["arrival_date"] == "double"


def test_run_concurrently_returns_results_and_raises_failures(spark):
    import pytest

    from portolan.session import run_concurrently

    out = run_concurrently({"a": lambda: spark.range(5).count(), "b": lambda: 7})
    assert out == {"a": 5, "b": 7}

    def boom():
        raise ValueError("failed step")

    with pytest.raises(ValueError, match="failed step"):
        run_concurrently({"ok": lambda: spark.range(3).count(), "bad": boom})
