"""Counts kept with the fact's months answer as the fact does."""

import pytest
from conftest import SF_SMALL

from portolan.functions.dates import month_key
from portolan.operators import profile
from portolan.plans import analytics, job, monthly_counts
from portolan.plans.registry import sources
from portolan.plans.star import Sources
from portolan.session import remove_path
from portolan.sources import published

OLD, NEW = "1995-03", "1996-07"


@pytest.fixture(scope="module")
def src(spark):
    s = sources(spark, SF_SMALL)
    return s.arrivals.withColumn("m", month_key("arrdate")).filter(f"m IN ('{OLD}', '{NEW}')").drop("m").cache(), s


def _load(spark, src, out, months, change=lambda df: df):
    arrivals, s = src
    raw = change(arrivals.filter(month_key("arrdate").isin(months)))
    return job.run(spark, Sources(raw, s.cities, s.ports, s.temperatures), out, raise_on_failure=False, months=months)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _same(spark, out):
    """Every question, from counts and from the fact."""
    counts, t = monthly_counts.read(spark, out), published.read(spark, out)
    f = t["fact_immigrations"]
    assert _rows(monthly_counts.weekday_counts(counts, t["dim_time"])) == _rows(analytics.weekday_counts(f, t["dim_time"]))
    assert _rows(monthly_counts.port_types(counts, t["dim_ports"])) == _rows(analytics.port_types(f, t["dim_ports"]))
    assert monthly_counts.top_cities(counts).collect() == analytics.top_cities(f).collect()
    assert monthly_counts.oldest(counts).collect() == analytics.oldest(f).collect()
    cols = ["visa", "visatype", "arrival_mode", "age", "gender", "origin"]
    assert _rows(monthly_counts.profile(counts, cols)) == _rows(profile.profile(f, cols))
    by_month = {r["month"]: r["rows"] for r in monthly_counts.rows_by_month(counts).collect()}
    assert by_month == {r[0]: r[1] for r in f.groupBy(month_key("arrival_date")).count().collect()}
    return by_month


def test_counts_follow_loads_and_versions(spark, src, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        monthly_counts.read(spark, out)
    _load(spark, src, out, [OLD])
    first = published.current(spark, out)["months"]
    assert set(_same(spark, out)) == {OLD}
    _load(spark, src, out, [NEW])
    before = _same(spark, out)
    assert set(before) == {OLD, NEW}
    # Only the new month was counted: the old one's counts are where they were.
    now = published.current(spark, out)["months"]
    assert now[OLD] == first[OLD]
    load = now[NEW].split("/fact_immigrations/")[0]
    assert published.names_in(spark, f"{out}/{load}/fact_counts") == [f"month={NEW}"]
    # A month that comes again with fewer rows is counted anew; the other stays.
    gone = published.read(spark, out)["fact_immigrations"].filter(month_key("arrival_date") == NEW).first()["immigration_id"]
    _load(spark, src, out, [NEW], lambda df: df.filter(f"cicid <> {gone}"))
    after = _same(spark, out)
    assert after[OLD] == before[OLD] and after[NEW] < before[NEW]
    # Counts that no version names go with their month's rows.
    _load(spark, src, out, [NEW])
    _load(spark, src, out, [NEW])
    assert not published.names_in(spark, f"{out}/{load}/fact_counts") and _same(spark, out) == before
    # A month whose rows reach no port any more has no counts.
    _load(spark, src, out, [NEW], lambda df: df.withColumn("i94port", month_key("arrdate")))
    assert _same(spark, out) == {OLD: before[OLD]}


def test_a_month_stored_without_counts_is_counted_from_its_rows(spark, src, tmp_path):
    out = str(tmp_path / "out")
    _load(spark, src, out, [OLD, NEW])
    want = _same(spark, out)
    for month in (OLD, NEW):
        remove_path(spark, f"{out}/" + published.counts_folder(published.current(spark, out)["months"][month]))
        assert _same(spark, out) == want


def test_questions_read_counts_only(spark, src, tmp_path):
    out = str(tmp_path / "out")
    _load(spark, src, out, [OLD])
    opened = monthly_counts.top_cities(monthly_counts.read(spark, out)).inputFiles()
    assert opened and all("/fact_counts/" in f for f in opened)
    with pytest.raises(ValueError, match="no counts"):
        monthly_counts.profile(monthly_counts.read(spark, out), ["city"])


def test_nulls_count_as_values(spark):
    f = spark.createDataFrame([(1, None, None, 20454.0, None, None, None, None, None, None, None)] * 2,
                              monthly_counts.FACT_IMMIGRATIONS)
    counts = monthly_counts.count_months(f)
    assert {(r["month"], r["grouping"], r["n"]) for r in counts.collect()} == {
        ("2016-01", g, 2) for g in monthly_counts.GROUPINGS}
    assert _rows(monthly_counts.profile(counts, ["visa", "age"])) == [("age", None, 2), ("visa", None, 2)]
    assert monthly_counts.count_months(f.limit(0)).collect() == []
