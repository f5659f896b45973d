"""Every catalogue query against its DuckDB statement on the smallest driver
tables (the same comparison the driver makes at sf0.01)."""

import datetime as dt
import decimal
import os
from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from tallycheck.plans import catalog  # noqa: E402

SF = os.environ.get("TALLYCHECK_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_oracle(spark, con, name):
    sdf = catalog.QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(catalog.ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = Counter(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 4
