"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from txnlake.plans.oracle import ORACLE
from txnlake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) == 59


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    columns = list(rel.columns)
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    shown = lambda row: tuple(f"{v:.9g}" if isinstance(v, float) else repr(v) if v is None else str(v) for v in row)
    assert sorted(map(shown, got)) == sorted(shown([r[i] for i in order]) for r in rel.fetchall())
