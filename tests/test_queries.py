"""Every registered query runs at sf0.001; SQL-expressible ones equal DuckDB."""

import decimal
import math

import duckdb
import pytest

from lotmarket.plans import catalog
from lotmarket.plans.binding import TABLES
from conftest import SF_SMALL

SLOW = {"rf_fit"}


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(k for k in catalog.queries() if k not in SLOW))
def test_query(spark, con, key):
    df = catalog.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    sql = catalog.oracle_sql().get(key)
    if sql is None:
        assert got and len(cols) == len(got[0])
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    exp = [tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()]
    assert _rows(got) == _rows(exp)
