"""Every query that SQL can express against its DuckDB statement, on the smallest tables."""

import os
from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")

from tallycheck.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = Counter(tuple(dict(zip(names, r))[c] for c in columns) for r in cur.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want
