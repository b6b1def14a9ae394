"""Invariants of the star built from the generated tables."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from portolan.plans.registry import cleaned, sources, star
from portolan.plans.star import load_star


def _dupes(df, cols):
    return df.groupBy(*cols).count().filter("count > 1").count()


def test_every_fact_date_is_in_dim_time(spark):
    s = star(spark, SF_SMALL)
    days = s["dim_time"].select("sas_timestamp")
    for c in ("arrival_date", "departure_date"):
        f = s["fact_immigrations"].select(F.col(c).alias("sas_timestamp"))
        assert f.join(days, "sas_timestamp", "left_anti").count() == 0, c


def test_dimension_keys_are_unique_at_their_grain(spark):
    s = star(spark, SF_SMALL)
    assert _dupes(s["dim_time"], ["sas_timestamp"]) == 0
    assert _dupes(s["dim_ports"], ["port_id"]) == 0
    assert _dupes(s["dim_temperatures"], ["city"]) == 0
    assert _dupes(s["dim_cities"], ["city", "state"]) == 0


def test_fact_never_multiplies_arrivals_when_port_keys_are_unique(spark):
    s = star(spark, SF_SMALL)
    assert _dupes(s["dim_ports"], ["iso_region", "iata_code"]) == 0
    assert 0 < s["fact_immigrations"].count() <= cleaned(spark, SF_SMALL)["arrivals"].count()


def test_loading_twice_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "wh")
    first = {k: sorted(v.collect()) for k, v in load_star(spark, sources(spark, SF_SMALL), base).items()}
    second = {k: sorted(v.collect()) for k, v in load_star(spark, sources(spark, SF_SMALL), base).items()}
    assert first == second
    assert all(first.values())
