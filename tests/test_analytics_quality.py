import random

from pyspark.sql import functions as F

from portolan.operators import profile, quality
from portolan.plans import analytics

FACT_SCHEMA = ("immigration_id int, origin int, landing_port string, arrival_date double, "
               "departure_date double, arrival_mode int, city string, age int, visa int, "
               "visatype string, gender string")


def _fact(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d = float(20454 + rnd.randrange(40))
        rows.append((i, 101, rnd.choice(["ORL", "MIA", "TPA"]), d, d + 3, 1,
                     rnd.choice(["Orlando", "Miami", "Tampa", "Naples"]), rnd.randrange(0, 90),
                     rnd.randrange(1, 4), "WT", rnd.choice(["F", "M"])))
    return spark.createDataFrame(rows, FACT_SCHEMA)


def _dim_time(spark, fact, dup=False):
    from portolan.operators.dims import dim_time
    t = dim_time(fact)
    return t.unionByName(t) if dup else t


def test_weekday_counts_equal_plain_join_count(spark):
    f = _fact(spark)
    for dup in (False, True):          # duplicate time keys multiply both forms alike
        t = _dim_time(spark, f, dup)
        got = {r.arrival_day: r["count"] for r in analytics.weekday_counts(f, t).collect()}
        naive = (f.join(t, f.arrival_date == t.sas_timestamp).groupBy("weekday").count())
        assert got == {r.weekday: r["count"] for r in naive.collect()}


def test_port_types_equal_plain_join_count(spark):
    f = _fact(spark)
    p = spark.createDataFrame([("1", "a", "Orlando", "small", "ORL", "FL"),
                               ("2", "b", "Miami", "large", "MIA", "FL"),
                               ("3", "c", "Miami", "heli", "MIA", "FL")],
                              "port_id string, name string, city string, type string, iata_code string, iso_region string")
    got = {r.port_type: r.total for r in analytics.port_types(f, p).collect()}
    naive = f.join(p, (f.city == p.city) & (f.landing_port == p.iata_code)).groupBy("type").count()
    assert got == {r.type: r["count"] for r in naive.collect()}


def test_top_cities_ties_ordered_by_city(spark):
    rows = [(i, c) for i, c in enumerate(["b", "a", "c", "c", "d", "e", "f"])]
    f = spark.createDataFrame(rows, "immigration_id int, city string")
    assert [r.city for r in analytics.top_cities(f, 3).collect()] == ["c", "a", "b"]


def test_oldest_and_young(spark):
    f = _fact(spark)
    assert analytics.oldest(f).first().age == max(r.age for r in f.collect())
    t = _dim_time(spark, f)
    young = analytics.young_arrivals(f, t, "ORL", 5)
    want = f.filter("age < 5 AND landing_port = 'ORL'").count()
    assert young.count() == want and young.columns == ["immigration_id", "age", "day"]


def test_quality_checks_pass_and_fail(spark):
    good = spark.createDataFrame([(1,), (2,)], "k int")
    bad = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    tables = {"good": good, "bad": bad, "empty": empty}
    keys = {"good": "k", "bad": "k", "empty": "k"}
    rep = {(r.table_name, r.check_name): (r.observed, r.passed)
           for r in quality.quality_report(tables, keys).collect()}
    assert rep[("good", "row_count")] == (2, True)
    assert rep[("empty", "row_count")] == (0, False)
    assert rep[("bad", "null_key")] == (1, False)
    assert rep[("bad", "unique_key")] == (2, False)
    assert rep[("good", "unique_key")] == (0, True)
    try:
        quality.raise_on_failure(quality.quality_report(tables, keys))
        raise AssertionError("expected failure")
    except AssertionError as ex:
        assert "bad.null_key" in str(ex)


def test_null_profile_and_value_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a")], "x double, s string")
    row = profile.null_profile(df).first()
    assert (row.x, row.s) == (2, 1)
    vc = profile.value_counts(df, "s").collect()
    assert [(r.s, r["count"]) for r in vc] == [("a", 2), (None, 1)]
    long = {(r.column_name, r.value): r["count"] for r in profile.profile(df, ["s"]).collect()}
    assert long == {("s", "a"): 2, ("s", None): 1}


def test_profile_is_one_aggregation(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"))
    plan = profile.profile(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_stack_months_then_distinct_complete_count(spark):
    from portolan.operators.fact import distinct_complete_count, stack_months
    jan = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, g string")
    feb = spark.createDataFrame([("a", 1), ("b", 3)], "g string, id int")
    both = stack_months(jan, feb)
    assert both.count() == 5
    assert distinct_complete_count(both).first().n_rows == 2
