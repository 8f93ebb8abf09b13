"""The analytical questions, on the driver's tables: an order is the event, its lines are the people at it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starpanel.operators.dims import calendar, time_band, times_of_day
from starpanel.plans.catalogue import day, long, orders_by_cell, panel_of, panel_sql, query, t

c = F.col


def _lines(spark, d):
    """Lines with the day and the number of their order."""
    o = t(spark, d, "orders").select("o_orderkey", day().alias("day"), "o_custkey", "o_orderpriority", "o_orderdate")
    return t(spark, d, "lineitem").join(o, c("l_orderkey") == c("o_orderkey"))


@query("grain_counts", "SELECT count(*) AS people, count(DISTINCT l_orderkey) AS orders FROM lineitem")
def _(spark, d):
    return t(spark, d, "lineitem").agg(F.count("*").alias("people"), F.count_distinct("l_orderkey").alias("orders"))


@query("date_bounds_filtered", "SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus IN ('F', 'O')")
def _(spark, d):
    o = t(spark, d, "orders").where(c("o_totalprice").between(1000, 200000) & c("o_orderstatus").isin("F", "O"))
    return o.agg(F.min(day()).alias("first_day"), F.max(day()).alias("last_day"))


@query("distinct_in_year", "SELECT count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1997")
def _(spark, d):
    return _lines(spark, d).where(F.year("day") == 1997).agg(F.count_distinct("l_orderkey").alias("orders"))


@query("distinct_per_year", "SELECT year(o_orderdate) AS year, count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1")
def _(spark, d):
    return _lines(spark, d).where(F.year("day").between(1996, 2000)).groupBy(long(F.year("day")).alias("year")).agg(F.count_distinct("l_orderkey").alias("orders"))


@query("top_cells", "SELECT n_name AS cell_id, count(DISTINCT o_orderkey) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, d):
    return orders_by_cell(spark, d).groupBy("cell_id").agg(F.count_distinct("event").alias("orders")).orderBy(F.desc("orders"), "cell_id").limit(10)


@query("additive_flags", "SELECT CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines FROM lineitem")
def _(spark, d):
    return t(spark, d, "lineitem").agg(F.sum(long(c("l_returnflag") == "R")).alias("returned"), F.sum(long(c("l_linestatus") == "O")).alias("open_lines"))


@query("by_weekday", "SELECT dayname(o_orderdate) AS day_of_week_name, count(*) AS orders FROM orders GROUP BY 1")
def _(spark, d):
    cal = calendar(spark, "1990-01-01", "2005-12-31").select("full_date", "day_of_week_name")
    return t(spark, d, "orders").join(cal, day() == c("full_date")).groupBy("day_of_week_name").agg(F.count("*").alias("orders"))


@query("by_hour_top5", "SELECT hour(ts) AS hour_24, count(*) AS events FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _(spark, d):
    times = times_of_day(spark).select("time_key", "hour_24")
    e = t(spark, d, "events").join(times, F.hour("ts") * 100 + F.minute("ts") == c("time_key"))
    return e.groupBy("hour_24").agg(F.count("*").alias("events")).orderBy(F.desc("events"), "hour_24").limit(5)


@query("weekday_by_band", """SELECT dayname(ts) AS weekday, CASE WHEN hour(ts) < 5 THEN 'Overnight' WHEN hour(ts) < 7 THEN 'Early Morning' WHEN hour(ts) < 9 THEN 'Morning Rush' WHEN hour(ts) < 12 THEN 'Midday'
 WHEN hour(ts) < 15 THEN 'Afternoon' WHEN hour(ts) < 18 THEN 'Evening Rush' WHEN hour(ts) < 22 THEN 'Evening' ELSE 'Night' END AS band, count(*) AS events FROM events GROUP BY 1, 2""")
def _(spark, d):
    return t(spark, d, "events").groupBy(F.date_format("ts", "EEEE").alias("weekday"), time_band(F.hour("ts")).alias("band")).agg(F.count("*").alias("events"))


@query("label_top5", r"SELECT upper(trim(regexp_replace(o_orderpriority, '^\s*\d+\s*-\s*', ''))) AS label, count(*) AS orders FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _(spark, d):
    from starpanel.functions.semantics import strip_code

    return t(spark, d, "orders").groupBy(strip_code(c("o_orderpriority")).alias("label")).agg(F.count("*").alias("orders")).orderBy(F.desc("orders"), "label").limit(5)


_RANK = "CASE WHEN o_orderpriority LIKE '1%' THEN 5 WHEN o_orderpriority LIKE '2%' THEN 4 WHEN o_orderpriority LIKE '3%' THEN 3 ELSE 0 END"


@query("label_by_rank", f"SELECT CAST({_RANK} AS BIGINT) AS rank, o_orderpriority AS label, count(*) AS orders FROM orders GROUP BY 1, 2")
def _(spark, d):
    p = c("o_orderpriority")
    rank = F.when(p.startswith("1"), 5).when(p.startswith("2"), 4).when(p.startswith("3"), 3).otherwise(0)
    return t(spark, d, "orders").groupBy(long(rank).alias("rank"), p.alias("label")).agg(F.count("*").alias("orders"))


@query("avg_and_missing", "SELECT round(avg(l_quantity), 6) AS avg_quantity, count(*) - count(l_quantity) AS missing FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, d):
    j = t(spark, d, "orders").join(t(spark, d, "lineitem"), c("l_orderkey") == c("o_orderkey"), "left")
    return j.agg(F.round(F.avg("l_quantity"), 6).alias("avg_quantity"), (F.count("*") - F.count("l_quantity")).alias("missing"))


@query("three_valued_group", "SELECT CASE WHEN p_size < 5 THEN NULL ELSE p_size >= 25 END AS is_large, count(*) AS parts FROM part GROUP BY 1")
def _(spark, d):
    return t(spark, d, "part").groupBy(F.when(c("p_size") >= 5, c("p_size") >= 25).alias("is_large")).agg(F.count("*").alias("parts"))


@query("null_countif", "SELECT count(*) FILTER (WHERE l_shipdate IS NULL) AS missing FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, d):
    j = t(spark, d, "orders").join(t(spark, d, "lineitem"), c("l_orderkey") == c("o_orderkey"), "left")
    return j.agg(F.count_if(c("l_shipdate").isNull()).alias("missing"))


@query("latest_loads", "SELECT load_id, status FROM (VALUES ('a', 1, 'succeeded'), ('b', 2, 'failed'), ('c', 3, 'succeeded'), ('d', 4, 'succeeded'), ('e', 5, 'failed'), ('f', 6, 'succeeded')) AS v(load_id, n, status) ORDER BY n DESC LIMIT 5")
def _(spark, d):
    rows = [("a", 1, "succeeded"), ("b", 2, "failed"), ("c", 3, "succeeded"), ("d", 4, "succeeded"), ("e", 5, "failed"), ("f", 6, "succeeded")]
    return spark.createDataFrame(rows, "load_id string, n int, status string").orderBy(F.desc("n")).limit(5).select("load_id", "status")


@query("panel_shape", panel_sql("SELECT count(*) AS n_rows, count(DISTINCT cell_id) AS cells, count(DISTINCT day) AS days FROM p"))
def _(spark, d):
    return panel_of(spark, d)[0].agg(F.count("*").alias("n_rows"), F.count_distinct("cell_id").alias("cells"), F.count_distinct("day").alias("days"))


_PER_ORDER = "SELECT o_orderkey, year(any_value(o_orderdate)) AS year, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS hit FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"


@query("rate_after_collapse", f"SELECT year, count(*) AS orders, round(100.0 * sum(hit) / count(*), 4) AS pct FROM ({_PER_ORDER}) GROUP BY 1")
def _(spark, d):
    per = _lines(spark, d).groupBy("l_orderkey").agg(long(F.year(F.max("day"))).alias("year"), F.max(long(c("l_returnflag") == "R")).alias("hit"))
    return per.groupBy("year").agg(F.count("*").alias("orders"), F.round(100.0 * F.sum("hit") / F.count("*"), 4).alias("pct"))


@query("rate_wrong_grain", "SELECT year(o_orderdate) AS year, round(100.0 * avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 4) AS pct FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, d):
    return _lines(spark, d).groupBy(long(F.year("day")).alias("year")).agg(F.round(100.0 * F.avg(long(c("l_returnflag") == "R")), 4).alias("pct"))


@query("two_year_pivot", """SELECT n_name AS cell_id, count(DISTINCT CASE WHEN year(o_orderdate) = 1996 THEN o_orderkey END) AS y1996, count(DISTINCT CASE WHEN year(o_orderdate) = 1997 THEN o_orderkey END) AS y1997
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(spark, d):
    y = F.year("day")
    return orders_by_cell(spark, d).groupBy("cell_id").agg(F.count_distinct(F.when(y == 1996, c("event"))).alias("y1996"), F.count_distinct(F.when(y == 1997, c("event"))).alias("y1997"))


@query("rank_cells", """SELECT cell_id, returned, rank() OVER (ORDER BY returned DESC) AS rank FROM (SELECT n_name AS cell_id, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)""")
def _(spark, d):
    cells = orders_by_cell(spark, d)
    got = t(spark, d, "lineitem").join(cells, c("l_orderkey") == c("event")).groupBy("cell_id").agg(F.count_if(c("l_returnflag") == "R").alias("returned"))
    return got.select("cell_id", "returned", long(F.rank().over(Window.orderBy(F.desc("returned")))).alias("rank"))


@query("monthly_ma3", """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders FROM orders GROUP BY 1)
 SELECT month, orders, round(avg(orders) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3 FROM m""")
def _(spark, d):
    m = t(spark, d, "orders").groupBy(F.trunc(day(), "MM").alias("month")).agg(F.count("*").alias("orders"))
    return m.select("month", "orders", F.round(F.avg("orders").over(Window.orderBy("month").rowsBetween(-2, 0)), 6).alias("ma3"))


@query("share_having", """SELECT n_name AS cell_id, round(100.0 * sum(CAST(l_linestatus = 'O' AS INT)) / count(*), 4) AS pct_open FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
 GROUP BY 1 HAVING count(*) >= 500 AND pct_open > 40""")
def _(spark, d):
    s, n = t(spark, d, "supplier"), t(spark, d, "nation")
    j = t(spark, d, "lineitem").join(s, c("l_suppkey") == c("s_suppkey")).join(n, c("s_nationkey") == c("n_nationkey"))
    g = j.groupBy(c("n_name").alias("cell_id")).agg(F.round(100.0 * F.sum((c("l_linestatus") == "O").cast("int")) / F.count("*"), 4).alias("pct_open"), F.count("*").alias("n"))
    return g.where((c("n") >= 500) & (c("pct_open") > 40)).select("cell_id", "pct_open")


@query("top3_per_group", """SELECT cell_id, label, orders FROM (SELECT n_name AS cell_id, o_orderpriority AS label, count(*) AS orders, row_number() OVER (PARTITION BY n_name ORDER BY count(*) DESC, o_orderpriority) AS rn
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE rn <= 3""")
def _(spark, d):
    cells = orders_by_cell(spark, d).join(t(spark, d, "orders").select("o_orderkey", "o_orderpriority"), c("event") == c("o_orderkey"))
    g = cells.groupBy("cell_id", c("o_orderpriority").alias("label")).agg(F.count("*").alias("orders"))
    w = Window.partitionBy("cell_id").orderBy(F.desc("orders"), "label")
    return g.withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("rn")


_LAG = "date_diff('minute', o_orderdate, l_shipdate) / 60.0"


def _lag_hours():
    from starpanel.functions.semantics import minute_boundaries

    return minute_boundaries(c("o_orderdate"), c("l_shipdate")) / 60.0


@query("lag_by_class", f"SELECT o_orderpriority AS label, round(avg({_LAG}), 4) AS avg_hours, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, d):
    return _lines(spark, d).groupBy(c("o_orderpriority").alias("label")).agg(F.round(F.avg(_lag_hours()), 4).alias("avg_hours"), F.count("*").alias("n"))


@query("reporting_lag_quality", f"""SELECT l_returnflag AS source, count(*) FILTER (WHERE {_LAG} < 0) AS before_order, count(*) FILTER (WHERE {_LAG} > 24 * 30) AS over_30_days, count(*) FILTER (WHERE l_shipdate IS NULL) AS undated
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, d):
    lag = _lag_hours()
    return _lines(spark, d).groupBy(c("l_returnflag").alias("source")).agg(F.count_if(lag < 0).alias("before_order"), F.count_if(lag > 24 * 30).alias("over_30_days"), F.count_if(c("l_shipdate").isNull()).alias("undated"))


@query("semi_distinct", "SELECT count(DISTINCT o_orderkey) AS orders FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, d):
    r = t(spark, d, "lineitem").where("l_returnflag = 'R'")
    return t(spark, d, "orders").join(r, c("o_orderkey") == c("l_orderkey"), "left_semi").agg(F.count_distinct("o_orderkey").alias("orders"))


@query("year_over_year", """WITH y AS (SELECT n_name AS cell_id, year(o_orderdate) AS year, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
 SELECT cell_id, year, orders, orders - lag(orders) OVER (PARTITION BY cell_id ORDER BY year) AS change FROM y""")
def _(spark, d):
    y = orders_by_cell(spark, d).groupBy("cell_id", long(F.year("day")).alias("year")).agg(F.count("*").alias("orders"))
    return y.withColumn("change", c("orders") - F.lag("orders").over(Window.partitionBy("cell_id").orderBy("year")))


@query("worst_cell_days", panel_sql("SELECT cell_id, day, crashes FROM p ORDER BY crashes DESC, cell_id, day LIMIT 10"))
def _(spark, d):
    return panel_of(spark, d)[0].select("cell_id", "day", "crashes").orderBy(F.desc("crashes"), "cell_id", "day").limit(10)


@query("cell_means", panel_sql("SELECT cell_id, round(avg(crashes), 6) AS mean, max(crashes) AS most, count(*) FILTER (WHERE crashes = 0) AS quiet FROM p GROUP BY 1"))
def _(spark, d):
    return panel_of(spark, d)[0].groupBy("cell_id").agg(F.round(F.avg("crashes"), 6).alias("mean"), F.max("crashes").alias("most"), F.count_if(c("crashes") == 0).alias("quiet"))


@query("size_distribution", "WITH s AS (SELECT l_orderkey, count(*) AS people FROM lineitem GROUP BY 1) SELECT people, count(*) AS orders, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM s GROUP BY 1")
def _(spark, d):
    s = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("people")).groupBy("people").agg(F.count("*").alias("orders"))
    return s.select("people", "orders", F.round(100.0 * c("orders") / F.sum("orders").over(Window.partitionBy()), 4).alias("pct"))


@query("mixed_categories", "SELECT count(*) AS orders FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0 AND count(*) FILTER (WHERE l_returnflag = 'N') > 0)")
def _(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(c("l_returnflag") == "R").alias("r"), F.count_if(c("l_returnflag") == "N").alias("n"))
    return g.where("r > 0 AND n > 0").agg(F.count("*").alias("orders"))


@query("crossed_year", "SELECT count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(l_shipdate) > year(o_orderdate)")
def _(spark, d):
    cal = calendar(spark, "1990-01-01", "2005-12-31").select("full_date", "year")
    a, b = cal.select(c("full_date").alias("d1"), c("year").alias("y1")), cal.select(c("full_date").alias("d2"), c("year").alias("y2"))
    j = _lines(spark, d).join(a, c("day") == c("d1")).join(b, day("l_shipdate") == c("d2"))
    return j.where("y2 > y1").agg(F.count_distinct("o_orderkey").alias("orders"))


@query("year_by_era", "SELECT year(o_orderdate) AS year, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'before' ELSE 'after' END AS era, count(*) AS orders FROM orders GROUP BY 1, 2")
def _(spark, d):
    era = F.when(day() < F.lit("1998-01-01").cast("date"), "before").otherwise("after")
    return t(spark, d, "orders").groupBy(long(F.year("o_orderdate")).alias("year"), era.alias("era")).agg(F.count("*").alias("orders"))


@query("median_by_category", "SELECT l_returnflag AS category, quantile_disc(l_quantity, 0.5) AS median FROM lineitem GROUP BY 1")
def _(spark, d):
    return t(spark, d, "lineitem").groupBy(c("l_returnflag").alias("category")).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY l_quantity)").alias("median"))


@query("lag_percentiles", f"SELECT year(o_orderdate) AS year, quantile_disc({_LAG}, 0.5) AS p50, quantile_disc({_LAG}, 0.9) AS p90, quantile_disc({_LAG}, 0.99) AS p99 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, d):
    p = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY lag)")
    return _lines(spark, d).withColumn("lag", _lag_hours()).groupBy(long(F.year("day")).alias("year")).agg(p(0.5).alias("p50"), p(0.9).alias("p90"), p(0.99).alias("p99"))


@query("elapsed_stats", "WITH e AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1) SELECT count(*) AS users, CAST(max(date_sub('second', a, b)) AS BIGINT) AS longest, round(avg(date_sub('second', a, b)), 4) AS mean FROM e")
def _(spark, d):
    e = t(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    s = F.timestamp_diff("SECOND", c("a"), c("b"))
    return e.agg(F.count("*").alias("users"), F.max(s).alias("longest"), F.round(F.avg(s), 4).alias("mean"))


@query("longest_quiet_run", panel_sql(""", z AS (SELECT cell_id, day, day - CAST(row_number() OVER (PARTITION BY cell_id ORDER BY day) AS INTEGER) AS run FROM p WHERE crashes = 0)
 SELECT cell_id, max(n) AS days FROM (SELECT cell_id, run, count(*) AS n FROM z GROUP BY 1, 2) GROUP BY 1"""))
def _(spark, d):
    z = panel_of(spark, d)[0].where("crashes = 0")
    z = z.withColumn("run", F.date_sub("day", F.row_number().over(Window.partitionBy("cell_id").orderBy("day"))))
    return z.groupBy("cell_id", "run").agg(F.count("*").alias("n")).groupBy("cell_id").agg(F.max("n").alias("days"))


@query("best_7day_window", panel_sql(""", s AS (SELECT cell_id, day, CAST(sum(crashes) OVER (PARTITION BY cell_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM p)
 SELECT cell_id, day, total FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY total DESC, day) AS rn FROM s) WHERE rn = 1"""))
def _(spark, d):
    w = Window.partitionBy("cell_id")
    s = panel_of(spark, d)[0].select("cell_id", "day", F.sum("crashes").over(w.orderBy("day").rowsBetween(-6, 0)).alias("total"))
    return s.withColumn("rn", F.row_number().over(w.orderBy(F.desc("total"), "day"))).where("rn = 1").drop("rn")


@query("era_bounds", "SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'before' ELSE 'after' END AS era, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, count(*) AS orders FROM orders GROUP BY 1")
def _(spark, d):
    era = F.when(day() < F.lit("1998-01-01").cast("date"), "before").otherwise("after")
    return t(spark, d, "orders").groupBy(era.alias("era")).agg(F.min(day()).alias("first_day"), F.max(day()).alias("last_day"), F.count("*").alias("orders"))


@query("people_per_order", "SELECT o_orderpriority AS label, round(count(*) * 1.0 / count(DISTINCT l_orderkey), 4) AS per_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 100")
def _(spark, d):
    g = _lines(spark, d).groupBy(c("o_orderpriority").alias("label")).agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("k"))
    return g.where("k >= 100").select("label", F.round(c("n") * 1.0 / c("k"), 4).alias("per_order"))


@query("month_totals", panel_sql("SELECT month(day) AS month_number, CAST(sum(crashes) AS BIGINT) AS crashes, count(DISTINCT day) AS days FROM p GROUP BY 1"))
def _(spark, d):
    cal = calendar(spark, "1990-01-01", "2005-12-31").select(c("full_date").alias("day"), "month_number")
    return panel_of(spark, d)[0].join(cal, "day").groupBy("month_number").agg(F.sum("crashes").alias("crashes"), F.count_distinct("day").alias("days"))


@query("same_months_yoy", """SELECT n_name AS cell_id, count(DISTINCT CASE WHEN year(o_orderdate) = 2000 THEN o_orderkey END) AS y2000, count(DISTINCT CASE WHEN year(o_orderdate) = 2001 THEN o_orderkey END) AS y2001,
 round(100.0 * (count(DISTINCT CASE WHEN year(o_orderdate) = 2001 THEN o_orderkey END) - count(DISTINCT CASE WHEN year(o_orderdate) = 2000 THEN o_orderkey END)) / nullif(count(DISTINCT CASE WHEN year(o_orderdate) = 2000 THEN o_orderkey END), 0), 4) AS pct
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE month(o_orderdate) <= 7 AND year(o_orderdate) IN (2000, 2001) GROUP BY 1""")
def _(spark, d):
    y = F.year("day")
    g = orders_by_cell(spark, d).where((F.month("day") <= 7) & y.isin(2000, 2001)).groupBy("cell_id").agg(F.count_distinct(F.when(y == 2000, c("event"))).alias("y2000"), F.count_distinct(F.when(y == 2001, c("event"))).alias("y2001"))
    return g.withColumn("pct", F.round(F.try_divide(100.0 * (c("y2001") - c("y2000")), c("y2000")), 4))


@query("inconsistent_attributes", "SELECT count(*) AS orders FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1)")
def _(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_linestatus").alias("n")).where("n > 1").agg(F.count("*").alias("orders"))


@query("label_check", panel_sql(""", r AS (SELECT a.cell_id, a.day, CAST(sum(b.crashes) AS BIGINT) AS s FROM p a JOIN p b ON a.cell_id = b.cell_id AND b.day BETWEEN a.day + 1 AND a.day + 7 GROUP BY 1, 2 HAVING count(*) = 7)
 SELECT count(*) AS n_rows, count(*) FILTER (WHERE p.crashes_next_7 IS DISTINCT FROM r.s) AS wrong, count(*) FILTER (WHERE p.crashes_next_7 IS NULL) AS open_rows FROM p LEFT JOIN r ON p.cell_id = r.cell_id AND p.day = r.day"""))
def _(spark, d):
    from starpanel.plans.panel import label_mismatches

    p = panel_of(spark, d)[0]
    wrong = label_mismatches(p).withColumn("bad", F.lit(True))
    return p.join(wrong, ["cell_id", "day"], "left").agg(F.count("*").alias("n_rows"), F.count_if("bad").alias("wrong"), F.count_if(c("crashes_next_7").isNull()).alias("open_rows"))


@query("rate_with_floor", """SELECT n_name AS cell_id, round(1000.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 4) AS per_1000 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(*) >= 1000""")
def _(spark, d):
    j = t(spark, d, "lineitem").join(orders_by_cell(spark, d), c("l_orderkey") == c("event"))
    g = j.groupBy("cell_id").agg(F.count_if(c("l_returnflag") == "R").alias("r"), F.count("*").alias("n"))
    return g.where("n >= 1000").select("cell_id", F.round(F.try_divide(1000.0 * c("r"), c("n")), 4).alias("per_1000"))


@query("anomaly_days", panel_sql("SELECT cell_id, day, crashes FROM p WHERE roll_28 > 0 AND crashes >= 3 * roll_28 AND crashes >= 3"))
def _(spark, d):
    return panel_of(spark, d)[0].where("roll_28 > 0 AND crashes >= 3 * roll_28 AND crashes >= 3").select("cell_id", "day", "crashes")


@query("reconcile_two_snapshots", """WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 17 <> 0), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 23 <> 0)
 SELECT (SELECT count(*) FROM a) AS staged, (SELECT count(*) FROM b) AS loaded, (SELECT count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k)) AS only_staged, (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = b.k)) AS only_loaded""")
def _(spark, d):
    k = t(spark, d, "lineitem").select(c("l_orderkey").alias("k")).distinct()
    a, b = k.where("k % 17 <> 0"), k.where("k % 23 <> 0")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a, "staged").join(n(b, "loaded")).join(n(a.join(b, "k", "left_anti"), "only_staged")).join(n(b.join(a, "k", "left_anti"), "only_loaded"))


@query("pivot_counts", """SELECT l_orderkey AS event, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n FROM lineitem GROUP BY 1
 HAVING count(*) FILTER (WHERE l_returnflag = 'R') >= 2""")
def _(spark, d):
    g = t(spark, d, "lineitem").groupBy(c("l_orderkey").alias("event")).agg(*(F.count_if(c("l_returnflag") == x.upper()).alias(x) for x in "ran"))
    return g.where("r >= 2")


@query("halfway_date", """WITH n AS (SELECT n_name AS cell_id, CAST(o_orderdate AS DATE) AS day, count(*) AS k FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
 r AS (SELECT *, sum(k) OVER (PARTITION BY cell_id ORDER BY day) AS run, sum(k) OVER (PARTITION BY cell_id) AS total FROM n) SELECT cell_id, min(day) AS halfway FROM r WHERE run * 2 >= total GROUP BY 1""")
def _(spark, d):
    n = orders_by_cell(spark, d).groupBy("cell_id", "day").agg(F.count("*").alias("k"))
    w = Window.partitionBy("cell_id")
    r = n.withColumn("run", F.sum("k").over(w.orderBy("day"))).withColumn("total", F.sum("k").over(w))
    return r.where("run * 2 >= total").groupBy("cell_id").agg(F.min("day").alias("halfway"))
