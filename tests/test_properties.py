"""Property tests: native expressions against plain-Python definitions."""

import datetime
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from portolan.functions import region_suffix, sas_to_date
from portolan.operators import clean

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

EPOCH = datetime.date(1960, 1, 1)


def _python_sas_date(x):
    if x is None or math.isnan(x):
        return None
    return EPOCH + datetime.timedelta(days=math.floor(x))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.just(math.nan), st.floats(min_value=-20000, max_value=40000)),
                min_size=1, max_size=40))
def test_sas_to_date_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(sas_to_date("x")).collect()]
    assert got == [_python_sas_date(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="US-CAXZ", max_size=8)), min_size=1, max_size=30))
def test_region_suffix_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "r string")
    got = [r[0] for r in df.select(region_suffix("r")).collect()]
    want = [None if v is None or len(v.split("-")) < 2 else v.split("-")[1] for v in values]
    assert got == want


_row = st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), st.integers(0, 2))


@SETTINGS
@given(st.lists(_row, min_size=1, max_size=40))
def test_dedup_then_complete_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, extra int")
    got = sorted(tuple(r) for r in clean.drop_incomplete(clean.dedup_rows(df).select("k", "s")).collect())
    p = pd.DataFrame(rows, columns=["k", "s", "extra"]).drop_duplicates()[["k", "s"]].dropna()
    want = sorted((int(a), b) for a, b in p.itertuples(index=False))
    assert got == want
