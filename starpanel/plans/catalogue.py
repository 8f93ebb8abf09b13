"""The registry of queries: each Spark plan stands beside the SQL that a second engine can hold it against."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.plans import panel as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: str = "o_orderdate"):
    return F.col(c).cast("date")


def long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def orders_by_cell(spark: SparkSession, sf_dir: str, scheme: str = "n_name") -> DataFrame:
    """(event, day, cell_id): an order, its day, and its customer's nation, region or market segment."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    if scheme != "c_mktsegment":
        n = t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
        j = j.join(n, j.c_nationkey == n.n_nationkey)
    if scheme == "r_name":
        r = t(spark, sf_dir, "region")
        j = j.join(r, j.n_regionkey == r.r_regionkey)
    return j.select(F.col("o_orderkey").alias("event"), day().alias("day"), F.col(scheme).alias("cell_id"))


PANEL_START = dt.date(1995, 1, 1)


def panel_of(spark: SparkSession, sf_dir: str, scheme: str = "n_name") -> tuple[DataFrame, dt.date, DataFrame]:
    """(cell_id, day, crashes and features), the panel's last day, and its cells."""
    events = orders_by_cell(spark, sf_dir, scheme)
    end = P.panel_end(t(spark, sf_dir, "orders").select(day().alias("day")), dt.date(2100, 1, 1), 7)
    events = events.where(F.col("day").between(F.lit(PANEL_START), F.lit(end)))
    cells = P.eligible_cells(events, 100)
    return P.lag_features(P.grid(cells, events, PANEL_START, end), end), end, cells


EVENTS_SQL = """ev AS (SELECT o_orderkey AS event, CAST(o_orderdate AS DATE) AS day, {scheme} AS cell_id FROM orders
 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
PANEL_SQL = (
    "WITH " + EVENTS_SQL + """,
pend AS (SELECT max(CAST(o_orderdate AS DATE)) - 7 AS e FROM orders),
pe AS (SELECT event, day, cell_id FROM ev, pend WHERE day BETWEEN DATE '1995-01-01' AND e),
cells AS (SELECT cell_id, count(*) AS events FROM pe WHERE cell_id IS NOT NULL GROUP BY cell_id HAVING count(*) >= 100),
days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', (SELECT e FROM pend), INTERVAL 1 DAY)) AS DATE) AS day),
cnt AS (SELECT cell_id, day, count(*) AS n FROM pe GROUP BY cell_id, day),
grid AS (SELECT c.cell_id, d.day, coalesce(n.n, 0) AS crashes FROM cells c CROSS JOIN days d LEFT JOIN cnt n ON n.cell_id = c.cell_id AND n.day = d.day),
p AS (SELECT cell_id, day, crashes,
  CASE WHEN day <= (SELECT e FROM pend) - 7 THEN CAST(sum(crashes) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS BIGINT) END AS crashes_next_7,
  lag(crashes, 7) OVER w AS lag_7, lag(crashes, 364) OVER w AS lag_364,
  CASE WHEN count(*) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 14 THEN avg(crashes) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) END AS roll_28,
  CASE WHEN count(*) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 91 PRECEDING AND 1 PRECEDING) >= 30 THEN avg(crashes) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 91 PRECEDING AND 1 PRECEDING) END AS roll_91
  FROM grid WINDOW w AS (PARTITION BY cell_id ORDER BY day))
"""
)


def panel_sql(select: str, scheme: str = "n_name") -> str:
    return PANEL_SQL.format(scheme=scheme) + select


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def values_sql(rows: list[tuple], names: str, types: list[str] | None = None) -> str:
    """The same literal rows as a FROM item."""
    q = lambda v: "NULL" if v is None else ("true" if v else "false") if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"DATE '{v}'" if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else f"TIMESTAMP '{v}'" if isinstance(v, dt.datetime) else repr(v)
    return "(VALUES " + ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows) + f") AS v({names})"
