"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest
from conftest import SF_SMALL

from portolan.plans.oracle import ORACLE
from portolan.plans.registry import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = sorted(tuple(_norm(v) for v in r) for r in df.collect())
    cur = duck.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    want = sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    assert got == want
