"""Queries that SQL can express against their SQL, on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")
queries = pytest.importorskip("starpanel.llm.queries")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, data), con.sql(queries.ORACLE_SQL[name])
    names = sorted(want.columns)
    assert names == sorted(got.columns)
    of = want.fetchall()
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, (tuple(r[want.columns.index(n)] for n in names) for r in of)))
