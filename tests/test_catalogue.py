"""Every registered query against the SQL beside it, on the smallest tables."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

from starpanel.plans import library, questions  # noqa: E402, F401
from starpanel.plans.catalogue import QUERIES, SQL  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for n in TABLES:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{data}/{n}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) and math.isfinite(v) else repr(v)
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, engine, name):
    df = QUERIES[name](spark, data)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in SQL:
        want = engine.sql(SQL[name])
        assert got == rows(want.columns, want.fetchall())
    else:
        assert got[1]


def test_entry(spark, data):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["cell_id", "day", "crashes", "crashes_next_7", "lag_7", "lag_364", "roll_28", "roll_91"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert df.limit(1).count() == 1
