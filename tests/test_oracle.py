"""Registered queries equal their DuckDB oracle on the sf0.001 fixture."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from qualis.plans import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

NAMES = sorted(catalog.QUERIES)
SQL = catalog.oracle_sql()


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in ["region", "nation", "customer", "part", "orders", "lineitem"]:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(SQL)


def test_entry_runs(spark):
    r = E.entry(spark).collect()
    assert len(r) == 1 and 0 <= r[0]["score"] <= 100


def test_detection_is_verified(spark):
    r = E.queries()["detect_summary"](spark, SF).first()
    assert r.verdict == "VERIFIED" and r.missed == 0 and r.unexpected == 0
