"""The corpus queries that SQL can state, against DuckDB on whole tables."""

import os
import zlib

import duckdb
import pytest

from txnlake.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string"}
    assert {c: kinds[str(t)] for c, t in zip(rel.columns, rel.types)} == dict(df.dtypes)
    order = [list(rel.columns).index(c) for c in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in order)) for r in rel.fetchall())


def test_crc32(con):
    for s in ("0", "7", "123456789", "-5"):
        assert con.sql(f"SELECT {oracle._CRC32} FROM (SELECT '{s}' AS s)").fetchall()[0][0] == zlib.crc32(s.encode())
