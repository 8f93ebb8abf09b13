"""Queries of the library's own operators: panel, dimensions, loads, cleaning, reports and guards."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from starpanel.functions import ladders as L
from starpanel.functions import semantics as S
from starpanel.operators import clean as C
from starpanel.operators import dims as D
from starpanel.operators import fact as X
from starpanel.operators.checks import LoadAborted, not_in
from starpanel.operators.holidays import holidays
from starpanel.plans import monitor, reports
from starpanel.plans import panel as P
from starpanel.plans.catalogue import SQL, day, long, orders_by_cell, panel_of, panel_sql, query, t, values, values_sql
from starpanel.sources.store import fingerprint

c = F.col

# ---------------------------------------------------------------- panel


@query("panel_features", panel_sql("SELECT * FROM p"))
def _(spark, d):
    return panel_of(spark, d)[0]


_CAL = """SELECT cell_id, day, dayofweek(day) + 1 AS dow, month(day) AS month, dayofweek(day) IN (0, 6) AS is_weekend, round(sin(2 * acos(-1) * dayofyear(day) / 365.25), 9) AS doy_sin, round(cos(2 * acos(-1) * dayofyear(day) / 365.25), 9) AS doy_cos FROM p"""


@query("panel_calendar", panel_sql(_CAL))
def _(spark, d):
    p, end, _ = panel_of(spark, d)
    p = P.calendar_features(p, P.PanelConfig(start=dt.date(1995, 1, 1)), end)
    return p.select("cell_id", "day", "dow", "month", "is_weekend", F.round("doy_sin", 9).alias("doy_sin"), F.round("doy_cos", 9).alias("doy_cos"))


_CELL_ATTRIBUTES = [("FRANCE", 10.5, 1200.0), ("CHINA", None, 900.0), ("BRAZIL", 3.25, None), ("NATION_1", 2.0, 10.0)]


@query("panel_exposure", panel_sql(f""", a AS (SELECT * FROM {values_sql(_CELL_ATTRIBUTES, 'cell_id, road_miles, aadt')})
 SELECT p.cell_id, day, coalesce(CAST(aadt AS DOUBLE), 1) * coalesce(CAST(road_miles AS DOUBLE), 1) * 24 AS exposure, round(ln(coalesce(CAST(aadt AS DOUBLE), 1) * coalesce(CAST(road_miles AS DOUBLE), 1) * 24), 9) AS log_exposure,
 CASE WHEN aadt IS NOT NULL AND road_miles IS NOT NULL THEN 'aadt_x_road_miles_x_hours' WHEN road_miles IS NOT NULL THEN 'road_miles_x_hours' WHEN aadt IS NOT NULL THEN 'aadt_x_hours' ELSE 'hours_only' END AS exposure_source
 FROM p LEFT JOIN a ON a.cell_id = p.cell_id"""))
def _(spark, d):
    a = values(spark, _CELL_ATTRIBUTES, "cell_id string, road_miles double, aadt double")
    value, log, form = P.exposure_columns(24)
    return panel_of(spark, d)[0].join(a, "cell_id", "left").select("cell_id", "day", value.alias("exposure"), F.round(log, 9).alias("log_exposure"), form.alias("exposure_source"))


_SPLIT = "CASE WHEN day < DATE '1999-01-01' THEN 'train' WHEN day < DATE '2000-06-01' THEN 'valid' ELSE 'test' END"
_SPLITS = P.PanelConfig(valid_start=dt.date(1999, 1, 1), test_start=dt.date(2000, 6, 1))


@query("panel_split_summary", panel_sql(f"SELECT {_SPLIT} AS split, count(*) AS n_rows, min(day) AS first_day, max(day) AS last_day, CAST(sum(crashes) AS BIGINT) AS crashes, round(avg(crashes), 9) AS mean FROM p GROUP BY 1"))
def _(spark, d):
    return reports.split_summary(panel_of(spark, d)[0].withColumn("split", P.split_label(_SPLITS)))


@query("panel_summary", panel_sql("""SELECT count(*) AS n_rows, count(DISTINCT cell_id) AS cells, CAST(sum(crashes) AS BIGINT) AS crashes, round(avg(crashes), 9) AS mean, round(count(*) FILTER (WHERE crashes = 0) / count(*), 9) AS zero_fraction,
 round(var_samp(crashes) / avg(crashes), 9) AS dispersion FROM p"""))
def _(spark, d):
    return reports.panel_summary(panel_of(spark, d)[0])


@query("leakage_recompute", panel_sql(""", r AS (SELECT a.cell_id, a.day, avg(CASE WHEN b.day >= a.day - 28 THEN b.crashes END) AS a28, count(*) FILTER (WHERE b.day >= a.day - 28) AS n28, avg(b.crashes) AS a91, count(*) AS n91, max(CASE WHEN b.day = a.day - 7 THEN b.crashes END) AS l7
 FROM p a JOIN p b ON b.cell_id = a.cell_id AND b.day BETWEEN a.day - 91 AND a.day - 1 GROUP BY 1, 2)
 SELECT p.cell_id, p.day, r.l7 AS lag_7, y.crashes AS lag_364, CASE WHEN n28 >= 14 THEN a28 END AS roll_28, CASE WHEN n91 >= 30 THEN a91 END AS roll_91
 FROM p LEFT JOIN r ON r.cell_id = p.cell_id AND r.day = p.day LEFT JOIN p y ON y.cell_id = p.cell_id AND y.day = p.day - 364""", "r_name"))
def _(spark, d):
    return P.recomputed_lags(panel_of(spark, d, "r_name")[0])


@query("leakage_violations", "SELECT 0 AS leaks, CAST(count(*) > 0 AS BOOLEAN) AS mutant_is_caught FROM orders")
def _(spark, d):
    p = panel_of(spark, d, "r_name")[0]
    mutant = p.withColumn("roll_28", F.avg("crashes").over(Window.partitionBy("cell_id").orderBy("day").rowsBetween(-27, 0)))
    return P.leaks(p).agg(F.count("*").cast("int").alias("leaks")).join(P.leaks(mutant).agg((F.count("*") > 0).alias("mutant_is_caught")))


@query("offset_self_join", panel_sql("SELECT a.cell_id, a.day, a.crashes, b.crashes AS year_ago FROM p a JOIN p b ON b.cell_id = a.cell_id AND b.day = a.day - 364", "r_name"))
def _(spark, d):
    p = panel_of(spark, d, "r_name")[0].select("cell_id", "day", "crashes")
    return p.join(p.select("cell_id", F.date_add("day", 364).alias("day"), c("crashes").alias("year_ago")), ["cell_id", "day"])


@query("forecast_baseline", panel_sql("SELECT round(avg(2 * (CASE WHEN crashes_next_7 > 0 THEN crashes_next_7 * ln(crashes_next_7 / greatest(7 * roll_28, 1e-9)) ELSE 0 END - (crashes_next_7 - greatest(7 * roll_28, 1e-9)))), 6) AS deviance FROM p WHERE crashes_next_7 IS NOT NULL AND roll_28 IS NOT NULL"))
def _(spark, d):
    p = panel_of(spark, d)[0].withColumn("expected", 7 * c("roll_28"))
    return P.poisson_deviance(p, "crashes_next_7", "expected").select(F.round("deviance", 6).alias("deviance"))



@query("accuracy_index", panel_sql(""", n AS (SELECT greatest(1, CAST(floor(count(*) * 0.01) AS BIGINT)) AS top, count(*) AS n, sum(crashes_next_7) AS every FROM p),
 b AS (SELECT crashes_next_7 FROM p WHERE roll_28 IS NOT NULL ORDER BY roll_28 DESC, cell_id, day LIMIT (SELECT top FROM n))
 SELECT round((SELECT sum(crashes_next_7) FROM b) / every / (top / n), 9) AS pai FROM n"""))
def _(spark, d):
    return P.predictive_accuracy_index(panel_of(spark, d)[0], "crashes_next_7", "roll_28").select(F.round("pai", 9).alias("pai"))


@query("holidays", """WITH y AS (SELECT unnest(generate_series(2015, 2026)) AS y), f AS (SELECT make_date(y, m, d) AS d FROM y, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) AS v(m, d) UNION ALL SELECT make_date(y, 6, 19) FROM y WHERE y >= 2021),
 n AS (SELECT make_date(y, m, 1) AS first, w, k FROM y, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) AS v(m, w, k)),
 l AS (SELECT last_day(make_date(y, 5, 1)) AS last FROM y)
 SELECT DISTINCT CAST(d AS DATE) AS day FROM (SELECT d FROM f UNION ALL SELECT CASE dayofweek(d) WHEN 6 THEN d - 1 WHEN 0 THEN d + 1 ELSE d END FROM f
 UNION ALL SELECT first + CAST((w - dayofweek(first) + 7) % 7 + 7 * (k - 1) AS INTEGER) FROM n UNION ALL SELECT last - CAST((dayofweek(last) + 6) % 7 AS INTEGER) FROM l)""")
def _(spark, d):
    return holidays(spark, 2015, 2026)


@query("held_out_cells", "WITH k AS (SELECT n_name AS cell_id, count(*) AS crashes FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) SELECT cell_id, crashes FROM k WHERE crashes < 600")
def _(spark, d):
    e = orders_by_cell(spark, d)
    return reports.held_out(e, P.eligible_cells(e, 600)).withColumnRenamed("events", "crashes")


_POINTS = [(f"C{i:02d}", round(-84.2 - 0.02 * ((i * 7) % 25), 4), round(39.0 + 0.013 * ((i * 11) % 25), 4)) for i in range(25)]
_HAVERSINE = "2 * 6371008.8 * asin(sqrt(pow(sin(radians(lat - 39.1011) / 2), 2) + cos(radians(lat)) * cos(radians(39.1011)) * pow(sin(radians(lon + 84.5125) / 2), 2)))"


@query("nearest_farthest", f"""WITH k AS (SELECT cell_id, round({_HAVERSINE} / 1000, 3) AS km FROM (SELECT cell_id, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat FROM {values_sql(_POINTS, 'cell_id, lon, lat')})),
 r AS (SELECT *, row_number() OVER (ORDER BY km, cell_id) AS near, row_number() OVER (ORDER BY km DESC, cell_id) AS far FROM k) SELECT cell_id, km, CASE WHEN near <= 5 THEN 'nearest' ELSE 'farthest' END AS side FROM r WHERE near <= 5 OR far <= 5""")
def _(spark, d):
    p = values(spark, _POINTS, "cell_id string, longitude double, latitude double")
    return reports.nearest_farthest(P.cell_distance(p), 5)


_CELL_POINTS = [("A", -84.50, 39.10), ("A", -84.52, 39.16), ("A", -84.51, 39.12), ("B", -84.40, 39.20), ("B", -84.42, 39.21), ("B", None, 39.3), ("C", None, None)]


@query("cell_distance", f"""WITH m AS (SELECT cell_id, quantile_disc(CAST(lon AS DOUBLE), 0.5) AS lon, quantile_disc(CAST(lat AS DOUBLE), 0.5) AS lat FROM {values_sql(_CELL_POINTS, 'cell_id, lon, lat')} WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1)
 SELECT cell_id, round({_HAVERSINE} / 1000, 3) AS distance_to_cbd_km FROM m""")
def _(spark, d):
    return P.cell_distance(values(spark, _CELL_POINTS, "cell_id string, longitude double, latitude double"))


@query("placement_disagreement", """SELECT scheme, count(DISTINCT l_orderkey) AS orders FROM (SELECT 'flag' AS scheme, l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1
 UNION ALL SELECT 'status', l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1 UNION ALL SELECT 'line', l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) > 1) GROUP BY 1""")
def _(spark, d):
    return reports.placement_disagreement(t(spark, d, "lineitem"), "l_orderkey", {"flag": c("l_returnflag"), "status": c("l_linestatus"), "line": c("l_linenumber").cast("string")}).withColumnRenamed("events", "orders")


# ---------------------------------------------------------------- dimensions


@query("calendar_dim", """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_of_week_name, upper(strftime(d, '%a')) AS day_of_week_abbr, dayofweek(d) IN (0, 6) AS is_weekend,
 day(d) AS day_of_month, weekofyear(d) AS week_of_year, month(d) AS month_number, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month, quarter(d) AS quarter, year(d) AS year
 FROM (SELECT CAST(unnest(generate_series(DATE '2010-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""")
def _(spark, d):
    return D.calendar(spark)


for _role in ("crash", "reported"):

    @query(f"{_role}_date_view", f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS {_role}_date_key, d AS {_role}_full_date, dayname(d) AS {_role}_day_name, dayofweek(d) IN (0, 6) AS {_role}_is_weekend, monthname(d) AS {_role}_month_name,
 strftime(d, '%Y-%m') AS {_role}_year_month, quarter(d) AS {_role}_quarter, year(d) AS {_role}_year FROM (SELECT CAST(unnest(generate_series(DATE '2010-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""")
    def _(spark, d, role=_role):
        return D.date_role(D.calendar(spark), role)


@query("time_dim", """SELECT h * 100 + m AS time_key, printf('%02d:%02d:00', h, m) AS time_of_day, h AS hour_24, CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END AS hour_12, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm, m AS minute_of_hour,
 printf('%02d:00-%02d:59', h, h) AS hour_label, CASE WHEN h < 5 THEN 'Overnight' WHEN h < 7 THEN 'Early Morning' WHEN h < 9 THEN 'Morning Rush' WHEN h < 12 THEN 'Midday' WHEN h < 15 THEN 'Afternoon' WHEN h < 18 THEN 'Evening Rush' WHEN h < 22 THEN 'Evening' ELSE 'Night' END AS time_of_day_band,
 h IN (7, 8, 15, 16, 17) AS is_rush_hour, h < 5 OR h >= 22 AS is_overnight FROM (SELECT unnest(generate_series(0, 23)) AS h), (SELECT unnest(generate_series(0, 59)) AS m)""")
def _(spark, d):
    return D.times_of_day(spark)


_DIMS = ("dim_date", "dim_time", "dim_location", "dim_conditions", "dim_crash_type", "dim_person_profile")


@query("unknown_members", "SELECT * FROM (VALUES ('dim_date', 19000101, 1), ('dim_time', -1, 1), ('dim_location', -1, 1), ('dim_conditions', -1, 1), ('dim_crash_type', -1, 1), ('dim_person_profile', -1, 1)) AS v(dim, k, n)")
def _(spark, d):
    from starpanel.schema import TABLES, empty

    out = None
    for name in _DIMS:
        twice = D.with_unknown(D.with_unknown(empty(spark, name), name), name)
        row = twice.groupBy(c(TABLES[name].key[0]).cast("int").alias("k")).agg(F.count("*").cast("int").alias("n")).select(F.lit(name).alias("dim"), "k", "n")
        out = row if out is None else out.unionByName(row)
    return out


_JUNK = "concat_ws('|', coalesce(p_brand, '~'), coalesce(p_type, '~'), coalesce(CAST(p_size AS VARCHAR), '~'))"


def _junk(spark, d):
    return t(spark, d, "part").select(S.natural_key(c("p_brand"), c("p_type"), c("p_size").cast("string")).alias("nk"), "p_brand", "p_type", "p_size")


@query("surrogate_keys", f"SELECT nk, 1000 + row_number() OVER (ORDER BY nk) AS k FROM (SELECT DISTINCT {_JUNK} AS nk FROM part)")
def _(spark, d):
    return D.numbered(_junk(spark, d).select("nk").distinct(), "k", ["nk"], 1000)


@query("dim_lookup_default", f"""WITH dim AS (SELECT nk, row_number() OVER (ORDER BY nk) AS k FROM (SELECT DISTINCT {_JUNK} AS nk FROM part WHERE p_size % 7 <> 0))
 SELECT coalesce(dim.k, -1) AS k, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN dim ON dim.nk = {_JUNK} GROUP BY 1""")
def _(spark, d):
    dim = D.numbered(_junk(spark, d).where("p_size % 7 <> 0").select("nk").distinct(), "k", ["nk"], 0)
    parts = t(spark, d, "part").select("p_partkey", S.natural_key(c("p_brand"), c("p_type"), c("p_size").cast("string")).alias("nk"))
    j = t(spark, d, "lineitem").join(parts, c("l_partkey") == c("p_partkey")).join(dim, "nk", "left")
    return j.groupBy(F.coalesce("k", F.lit(-1).cast("long")).alias("k")).agg(F.count("*").alias("lines"))


_MEMBERS = [("a|x", "old A"), ("b|x", "old B"), ("d|x", "old D")]
_FRESH = [("b|x", "new B"), ("c|x", "new C"), ("a0|x", "new A0")]


@query("dimension_merge", "SELECT * FROM (VALUES (-1, '~UNKNOWN~', NULL), (4, 'a|x', 'old A'), (9, 'b|x', 'new B'), (2, 'd|x', 'old D'), (10, 'a0|x', 'new A0'), (11, 'c|x', 'new C')) AS v(location_key, location_nk, address)")
def _(spark, d):
    from starpanel.schema import conform

    old = values(spark, [(-1, "~UNKNOWN~", None), (4, *_MEMBERS[0]), (9, *_MEMBERS[1]), (2, *_MEMBERS[2])], "location_key long, location_nk string, address string")
    fresh = conform(values(spark, _FRESH, "location_nk string, address string"), "dim_location").drop("location_key")
    return D.merge(conform(old, "dim_location"), fresh, "dim_location", "location_nk", reprocess=True).select(c("location_key").cast("int").alias("location_key"), "location_nk", "address")


# ---------------------------------------------------------------- change detection

_V1 = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem"
_V2 = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 29 <> 0"
_JSON = "to_json(struct_pack(l_orderkey := l_orderkey, l_linenumber := l_linenumber, l_partkey := l_partkey, l_suppkey := l_suppkey, q := CAST(l_quantity AS BIGINT), l_returnflag := l_returnflag))"
_HASHES = "SELECT CAST(l_orderkey AS VARCHAR) AS instanceid, md5(string_agg(j, chr(10) ORDER BY j)) AS crash_hash, count(*) AS person_rows FROM (SELECT l_orderkey, CAST({} AS VARCHAR) AS j FROM ({})) GROUP BY 1"


_CONTENT = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q", "l_returnflag")


def _people(spark, d, version: int):
    """Lines as people at an order; the second publish has changed and withdrawn orders."""
    x = t(spark, d, "lineitem")
    if version == 2:
        x = x.where("l_orderkey % 29 <> 0").withColumn("l_quantity", F.when(c("l_orderkey") % 13 == 0, c("l_quantity") + 1).otherwise(c("l_quantity")))
    x = x.withColumn("q", long("l_quantity"))
    return x.select(c("l_orderkey").cast("string").alias("instanceid"), *_CONTENT, "l_shipdate")


def _with_json(people):
    """The columns are shorter to move than their text, so they meet at their order before they are written out."""
    return people.repartition("instanceid").withColumn("row_json", S.row_json(*_CONTENT))


@query("content_hash", _HASHES.format(_JSON, _V1))
def _(spark, d):
    return X.crash_hashes(_with_json(_people(spark, d, 1)))


def _classified(spark, d):
    v1, v2 = _people(spark, d, 1).where("l_orderkey % 31 <> 0"), _people(spark, d, 2)
    # a left join: whoever needs no hash needs no join either, and the plan drops it
    fact = v1.join(X.crash_hashes(_with_json(v1)).select("instanceid", "crash_hash"), "instanceid", "left").withColumn("crash_date", F.when(c("l_orderkey") % 5 == 0, F.lit("1997-12-31")).otherwise("1998-01-02").cast("date"))
    return X.classify(_with_json(v2), fact, dt.date(1998, 1, 1)), v2, fact


_CLASS = f"""WITH a AS ({_HASHES.format(_JSON, _V1)}), b AS ({_HASHES.format(_JSON, _V2)}), f AS (SELECT * FROM a WHERE CAST(instanceid AS BIGINT) % 31 <> 0),
 df AS (SELECT b.instanceid, f.instanceid IS NULL AS is_new, f.instanceid IS NOT NULL AND CAST(b.instanceid AS BIGINT) % 5 = 0 AS deferred FROM b LEFT JOIN f ON f.instanceid = b.instanceid
 WHERE f.instanceid IS NULL OR f.crash_hash IS DISTINCT FROM b.crash_hash OR f.person_rows <> b.person_rows),
 gone AS (SELECT instanceid FROM f WHERE CAST(instanceid AS BIGINT) % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM b WHERE b.instanceid = f.instanceid))"""


@query("change_classify", _CLASS + " SELECT instanceid, is_new, deferred FROM df")
def _(spark, d):
    return _classified(spark, d)[0].differing.select("instanceid", "is_new", "deferred")


@query("removed_detect", _CLASS + " SELECT instanceid FROM gone")
def _(spark, d):
    return _classified(spark, d)[0].removed


@query("load_counts", _CLASS + " SELECT count(*) FILTER (WHERE is_new AND NOT deferred) AS crashes_new, count(*) FILTER (WHERE NOT is_new AND NOT deferred) AS crashes_changed, (SELECT count(*) FROM gone) AS crashes_removed, count(*) FILTER (WHERE deferred) AS crashes_deferred FROM df")
def _(spark, d):
    k = _classified(spark, d)[0]
    n = k.differing.agg(F.count_if(c("is_new") & ~c("deferred")).alias("crashes_new"), F.count_if(~c("is_new") & ~c("deferred")).alias("crashes_changed"), F.count_if("deferred").alias("crashes_deferred"))
    return n.join(k.removed.agg(F.count("*").alias("crashes_removed"))).select("crashes_new", "crashes_changed", "crashes_removed", "crashes_deferred")


@query("replace_result", _CLASS + f""", keep AS (SELECT CAST(l_orderkey AS VARCHAR) AS instanceid, CAST(l_quantity AS BIGINT) AS q FROM ({_V1}) WHERE l_orderkey % 31 <> 0),
 new AS (SELECT CAST(l_orderkey AS VARCHAR) AS instanceid, CAST(l_quantity AS BIGINT) AS q FROM ({_V2})), ch AS (SELECT instanceid FROM df WHERE NOT deferred)
 SELECT instanceid, count(*) AS n, CAST(sum(q) AS BIGINT) AS q FROM (SELECT * FROM keep WHERE instanceid NOT IN (SELECT instanceid FROM ch) AND instanceid NOT IN (SELECT instanceid FROM gone) UNION ALL SELECT * FROM new WHERE instanceid IN (SELECT instanceid FROM ch)) GROUP BY 1""")
def _(spark, d):
    k, v2, fact = _classified(spark, d)
    tag = lambda df: df.select("instanceid", F.lit(C.OWNED).alias("source_dataset"), "q")
    out = X.replaced(tag(fact), k.changed, k.removed, tag(v2.join(k.changed.select("instanceid"), "instanceid", "left_semi")))
    return out.groupBy("instanceid").agg(F.count("*").alias("n"), F.sum("q").alias("q"))


@query("driver_only_dedupe", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
 SELECT l_returnflag, count(*) AS kept FROM r WHERE l_returnflag <> 'R' OR rn = 1 GROUP BY 1""")
def _(spark, d):
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    r = t(spark, d, "lineitem").withColumn("rn", F.row_number().over(w)).where((c("l_returnflag") != "R") | (c("rn") == 1))
    return r.groupBy("l_returnflag").agg(F.count("*").alias("kept"))


@query("history_fill", """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND (CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END) IS NULL THEN c_mktsegment ELSE CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END END AS neighborhood
 FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey""")
def _(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", c("o_custkey").alias("localreportno"), F.when(day() < F.lit("1998-01-01").cast("date"), C.FROZEN).otherwise(C.OWNED).alias("source_dataset"), F.when(c("o_orderkey") % 3 != 0, c("o_orderstatus")).alias("neighborhood"))
    names = t(spark, d, "customer").where("c_custkey % 2 = 0").select(c("c_custkey").alias("localreportno"), c("c_mktsegment").alias("neighborhood"))
    return X.fill_history(o, names).select("o_orderkey", "neighborhood")


@query("second_load", SQL["replace_result"])
def _(spark, d):
    """The second delta is applied to a fact that the warehouse holds, and the fact is read from there again."""
    from starpanel.schema import conform
    from starpanel.sources.store import Warehouse, scratch

    k, v2, before = _classified(spark, d)
    w = Warehouse(spark, scratch(spark))
    rows = lambda df, on: df.select("instanceid", F.lit(C.OWNED).alias("source_dataset"), on.alias("crash_date"), c("q").alias("person_count"))
    w.commit({"fact_crash_person": rows(before, c("crash_date"))})  # the columns that it lacks are read as nulls
    changed, removed = (df.select("instanceid").persist(StorageLevel.DISK_ONLY) for df in (k.changed, k.removed))  # judged once
    try:
        new = conform(rows(v2.join(changed, "instanceid", "left_semi"), F.lit("1998-01-02").cast("date")), "fact_crash_person")
        w.commit({"fact_crash_person": X.replaced(w.read("fact_crash_person"), changed, removed, new)})
    finally:
        changed.unpersist()
        removed.unpersist()
    return w.read("fact_crash_person").groupBy("instanceid").agg(F.count("*").alias("n"), F.sum("person_count").alias("q"))


# ---------------------------------------------------------------- joins


@query("null_aware_not_in", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 10 = 0)")
def _(spark, d):
    return not_in(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders").where("o_custkey IS NOT NULL AND o_orderkey % 10 = 0"), "c_custkey", "o_custkey")


@query("not_in_with_null", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_custkey > 10 THEN o_custkey END FROM orders)")
def _(spark, d):
    return not_in(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders").select(F.when(c("o_custkey") > 10, c("o_custkey")).alias("k")), "c_custkey", "k")


@query("not_in_of_nulls", "WITH k AS (SELECT CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS k FROM customer) SELECT 'some' AS side, k FROM k WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) UNION ALL SELECT 'none', k FROM k WHERE k NOT IN (SELECT c_custkey FROM customer WHERE false)")
def _(spark, d):
    customer = t(spark, d, "customer").select("c_custkey")
    k = customer.select(F.when(c("c_custkey") % 3 > 0, c("c_custkey")).alias("k"))
    some, none = (not_in(k, customer.where(p), "k", "c_custkey") for p in ("c_custkey % 2 = 0", "false"))
    return some.select(F.lit("some").alias("side"), "k").unionByName(none.select(F.lit("none").alias("side"), "k"))


@query("anti_left_null", "SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def _(spark, d):
    return t(spark, d, "orders").join(t(spark, d, "lineitem"), c("l_orderkey") == c("o_orderkey"), "left_anti").select("o_orderkey")


@query("not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def _(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders").where("o_orderstatus = 'F'"), c("o_custkey") == c("c_custkey"), "left_anti").select("c_custkey")


@query("exists_guard", "SELECT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS any_negative")
def _(spark, d):
    return t(spark, d, "orders").where("o_totalprice < 0").limit(1).agg((F.count("*") > 0).alias("any_negative"))


@query("scalar_subquery", "SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 2) AS above FROM orders WHERE o_totalprice > (SELECT 1.9 * avg(o_totalprice) FROM orders)")
def _(spark, d):
    o = t(spark, d, "orders")
    mean = o.agg(F.avg("o_totalprice").alias("m"))
    return o.join(F.broadcast(mean)).where("o_totalprice > 1.9 * m").select("o_orderkey", F.round(c("o_totalprice") - c("m"), 2).alias("above"))


@query("arg_max_row", "SELECT l_returnflag, max(l_shipdate) AS newest, max(l_orderkey) FILTER (WHERE l_shipdate = m) AS at_newest FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY 1")
def _(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.max("l_shipdate").alias("newest"), F.max_by("l_orderkey", F.struct("l_shipdate", "l_orderkey")).alias("at_newest"))


@query("unanimous_aggregate", "SELECT l_orderkey, CASE WHEN count(DISTINCT l_linestatus) = 1 AND count(*) FILTER (WHERE l_linestatus IS NULL) = 0 THEN max(l_linestatus) END AS status, bool_and(l_quantity > 5) AS all_large FROM lineitem GROUP BY 1")
def _(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(S.unanimous(c("l_linestatus")).alias("status"), F.bool_and(c("l_quantity") > 5).alias("all_large"))


@query("coverage_union", """SELECT 'priority' AS attribute, o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority NOT LIKE '1%' GROUP BY 2 UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY 2""")
def _(spark, d):
    o, x = t(spark, d, "orders").where(~c("o_orderpriority").startswith("1")), t(spark, d, "lineitem")
    return reports.coverage({"priority": (o, "o_orderpriority"), "status": (x, "l_linestatus"), "flag": (x, "l_returnflag")})


@query("distinct_union", "SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def _(spark, d):
    return t(spark, d, "customer").select(c("c_nationkey").alias("k")).union(t(spark, d, "supplier").select("s_nationkey")).distinct()


@query("snapshot_probe", "SELECT count(*) AS n, count(o_orderstatus) AS stamped, min(o_orderstatus) AS low, max(o_orderstatus) AS high, count(*) FILTER (WHERE o_orderkey IS NULL) AS blank_ids, count(DISTINCT o_orderkey) AS ids FROM orders")
def _(spark, d):
    return t(spark, d, "orders").agg(F.count("*").alias("n"), F.count("o_orderstatus").alias("stamped"), F.min("o_orderstatus").alias("low"), F.max("o_orderstatus").alias("high"), F.count_if(c("o_orderkey").isNull()).alias("blank_ids"), F.count_distinct("o_orderkey").alias("ids"))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, d):
    from starpanel.operators.checks import repeated

    return repeated(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("json_payload", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def _(spark, d):
    return t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("total"))


@query("row_json", "SELECT o_orderkey, CAST(to_json(struct_pack(k := o_orderkey, s := CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END)) AS VARCHAR) AS j FROM orders")
def _(spark, d):
    return t(spark, d, "orders").select("o_orderkey", c("o_orderkey").alias("k"), F.when(c("o_orderkey") % 3 != 0, c("o_orderstatus")).alias("s")).select("o_orderkey", S.row_json("k", "s").alias("j"))


@query("table_fingerprint", "SELECT bit_xor(CAST('0x' || left(md5(CAST(to_json(struct_pack(o_orderkey := o_orderkey, o_orderstatus := o_orderstatus, o_custkey := o_custkey)) AS VARCHAR)), 15) AS BIGINT)) AS fingerprint FROM orders")
def _(spark, d):
    return fingerprint(t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"))


@query("except_replace", "SELECT * EXCLUDE (n_comment) REPLACE (upper(n_name) || '/' || n_regionkey AS n_name) FROM (SELECT n_nationkey, n_name, n_regionkey, 'x' AS n_comment FROM nation)")
def _(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey", F.lit("x").alias("n_comment"))
    return n.drop("n_comment").withColumn("n_name", F.concat_ws("/", F.upper("n_name"), "n_regionkey"))


@query("unknown_membership", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE -1 IN (CASE WHEN l_partkey % 10 = 0 THEN -1 ELSE 1 END, CASE WHEN l_suppkey % 10 = 0 THEN -1 END)")
def _(spark, d):
    return t(spark, d, "lineitem").where(F.lit(-1).isin(F.when(c("l_partkey") % 10 == 0, -1).otherwise(1), F.when(c("l_suppkey") % 10 == 0, -1))).select("l_orderkey", "l_linenumber")


@query("joined_names", "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _(spark, d):
    return t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), "; ").alias("names"))


# ---------------------------------------------------------------- cleaning, on literal rows

_ADDRESSES = ["1610 Joseph St", "6 Main St", "12", "249  E Mitchell Av ", "I75 at Hopple", "0.2 mi N", "100-102 Elm St", "5XX Vine St", "Vine St", "Not Applicable or Unknown", "", "   ", None]
_MASKED = ["16XX JOSEPH ST", "X MAIN ST", "XX", "2XX E MITCHELL AV", "I7X AT HOPPLE", "0.X MI N", "100-10X ELM ST", "XXX VINE ST", "VINE ST", None, None, None, None]


@query("mask_block", f"SELECT raw, masked FROM {values_sql(list(zip(_ADDRESSES, _MASKED)), 'raw, masked')}")
def _(spark, d):
    return values(spark, [(a,) for a in _ADDRESSES], "raw string").select("raw", S.mask_block(c("raw")).alias("masked"))


_CODED = ["3 - DARK - LIGHTED ROADWAY", "1-URGENT", " 12 -  dusk ", "Plain", "", None]


@query("strip_code", rf"SELECT raw, upper(regexp_replace(regexp_replace(raw, '^\s*\d+\s*-\s*', ''), '^\s+|\s+$', '', 'g')) AS label FROM {values_sql([(r,) for r in _CODED], 'raw')}")
def _(spark, d):
    return values(spark, [(r,) for r in _CODED], "raw string").select("raw", S.strip_code(c("raw")).alias("label"))


# Labels and what they become, as literals.
_UNSAID = ((None, "Unknown"), ("", "Unknown"))
_INJURED = "Injury (Severity Unspecified)"
_LABELS = {
    "light": (L.LIGHT, (*_UNSAID, ("DAYLIGHT", "Daylight"), ("DAWN", "Dawn"), ("DUSK", "Dusk"), ("DARK - ROADWAY NOT LIGHTED", "Dark - Not Lighted"), ("DARK - LIGHTED ROADWAY", "Dark - Lighted"),
        ("DARK - UNKNOWN ROADWAY LIGHTING", "Dark - Unknown Lighting"), ("DARK", "Dark - Unknown Lighting"), ("UNKNOWN", "Unknown"), ("GLARE", "Other"))),
    "road_condition": (L.ROAD_CONDITION, (*_UNSAID, ("DRY", "Dry"), ("WET", "Wet"), ("SNOW", "Snow"), ("ICE", "Ice"), ("SLUSH", "Slush"), ("WATER (STANDING)", "Standing/Moving Water"),
        ("SAND", "Sand/Mud/Dirt/Oil/Gravel"), ("UNKNOWN", "Unknown"), ("OTHER X", "Other"))),
    "contour": (L.CONTOUR, (*_UNSAID, ("STRAIGHT LEVEL", "Straight Level"), ("STRAIGHT GRADE", "Straight Grade"), ("CURVE LEVEL", "Curve Level"), ("CURVE GRADE", "Curve Grade"), ("HILL", "Unknown"))),
    "surface": (L.SURFACE, (*_UNSAID, ("BLACKTOP", "Blacktop/Asphalt"), ("CONCRETE", "Concrete"), ("BRICK", "Brick/Block"), ("SLAG", "Slag/Gravel/Stone"), ("DIRT", "Dirt"), ("UNKNOWN", "Unknown"), ("GLASS", "Other"))),
    "weather": (L.WEATHER, (*_UNSAID, ("CLEAR", "Clear"), ("CLOUDY", "Cloudy"), ("RAIN", "Rain"), ("SNOW", "Snow"), ("FREEZING RAIN", "Freezing Rain/Drizzle"), ("SLEET, HAIL", "Sleet/Hail"), ("FOG", "Fog/Smog/Smoke"),
        ("SEVERE CROSSWINDS", "Severe Crosswinds"), ("BLOWING SAND", "Blowing Sand/Soil/Dirt/Snow"), ("ASH", "Other/Unknown"))),
    "manner": (L.MANNER, (*_UNSAID, ("ANGLE", "Angle"), ("REAR-END", "Rear-End"), ("REAR-TO-REAR", "Rear-to-Rear"), ("HEAD-ON", "Head-On"), ("BACKING", "Backing"), ("SIDESWIPE, SAME DIRECTION", "Sideswipe - Same Direction"),
        ("SIDESWIPE, OPPOSITE", "Sideswipe - Opposite Direction"), ("NOT COLLISION BETWEEN", "Not Collision Between Two Motor Vehicles"), ("ODD", "Unknown"))),
    "severity": (L.SEVERITY, (*_UNSAID, ("FATAL", "Fatal"), ("SERIOUS INJURY SUSPECTED", "Serious Injury Suspected"), ("MINOR INJURY SUSPECTED", "Minor Injury Suspected"), ("INJURY POSSIBLE", "Possible Injury"),
        ("INJURY", _INJURED), ("NONFATAL INJURY", _INJURED), ("PROPERTY DAMAGE ONLY", "Property Damage Only"), ("ODD", "Unknown"))),
    "injury": (L.INJURY, (*_UNSAID, ("FATAL", "K - Fatal"), ("INCAPACITATING", "A - Suspected Serious"), ("SUSPECTED SERIOUS INJURY", "A - Suspected Serious"), ("NON-INCAPACITATING", "B - Suspected Minor"),
        ("SUSPECTED MINOR INJURY", "B - Suspected Minor"), ("POSSIBLE INJURY", "C - Possible"), ("NO APPARENTY INJURY", "O - No Apparent Injury"), ("ODD", "Unknown"))),
    "person": (L.PERSON, (*_UNSAID, ("DRIVER", "Driver"), ("OCCUPANT OF VEHICLE", "Occupant"), ("PEDESTRIAN", "Pedestrian"), ("RIDER", "Unknown"))),
    "gender": (L.GENDER, (*_UNSAID, ("MALE", "Male"), ("M", "Male"), ("FEMALE", "Female"), ("X", "Unknown"))),
}


def _ladder(name):
    ladder, labels = _LABELS[name]

    @query(f"ladders_{name}", f"SELECT raw, label FROM {values_sql(list(labels), 'raw, label')}")
    def _(spark, d):
        return values(spark, [(x,) for x, _ in labels], "raw string").select("raw", ladder.column(c("raw")).alias("label"))


for _name in _LABELS:
    _ladder(_name)

# Staged rows with what they say of the flags of their dimensions; None: it can't be told.
_FLAGS = ("is_dark", "is_slick", "is_curve", "is_grade", "is_adverse_weather", "is_collision", "is_injury_crash", "is_fatal_crash", "is_motorist", "is_intersection")
_STAGED = [
    (dict(socrata_id="a", lightconditionsprimary="4 - DARK - LIGHTIED ROADWAY", roadconditionsprimary="2 - WET", roadcontour="4 - CURVE GRADE", weather="3 - RAIN", mannerofcrash="2 - REAR-END", crashseverity="1 - FATAL", typeofperson="D - DRIVER", crashlocation="1 - FOUR-WAY INTERSECTION"),
     (True, True, True, True, True, True, True, True, True, True)),
    (dict(socrata_id="b", lightconditionsprimary="1 - DAYLIGHT", roadconditionsprimary="1 - DRY", roadcontour="1 - STRAIGHT LEVEL", weather="1 - CLEAR", mannerofcrash="1 - NOT COLLISION BETWEEN TWO MOTOR VEHICLES IN TRANSPORT", crashseverity="5 - PROPERTY DAMAGE ONLY", typeofperson="P - PEDESTRIAN", crashlocation="01 - NOT AN INTERSECTION"),
     (False, False, False, False, False, False, False, False, False, False)),
    (dict(socrata_id="c", lightconditionsprimary="9 - UNKNOWN", roadconditionsprimary="9 - UNKNOWN", roadcontour="9 - UNKNOWN", weather="9 - UNKNOWN", mannerofcrash="9 - UNKNOWN", crashseverity="9 - UNKNOWN", typeofperson="U - UNKNOWN", crashlocation="99 - UNKNOWN"),
     (False, False, False, False, False, None, None, None, None, None)),
    (dict(socrata_id="d", lightconditionsprimary="5 - DARK - ROADWAY NOT LIGHTED", roadconditionsprimary="7 - WATER (STANDING, MOVING)", roadcontour="2 - STRAIGHT GRADE", weather="2 - CLOUDY", mannerofcrash="6 - ANGLE", crashseverity="4 - INJURY POSSIBLE", typeofperson="O - OCCUPANT", crashlocation="06 - FIVE-POINT, OR MORE"),
     (True, True, False, True, False, True, True, False, True, True)),
    (dict(socrata_id="e", lightconditionsprimary="3 - DUSK", roadconditionsprimary="6 - SAND, MUD, DIRT, OIL, GRAVEL", roadcontour="3 - CURVE LEVEL", weather="8 - OTHER/UNKNOWN", mannerofcrash="3 - HEAD-ON", crashseverity="2 - INJURY", typeofperson="D - DRIVER", crashlocation="20 - DRIVEWAY"),
     (False, False, True, False, False, True, True, False, True, False)),
]


def _staged(spark):
    from starpanel.schema import STAGING_COLUMNS

    return values(spark, [tuple(r.get(n) for n in STAGING_COLUMNS) for r, _ in _STAGED], ", ".join(f"{n} string" for n in STAGING_COLUMNS))


@query("derived_flags", f"SELECT * FROM {values_sql([(r['socrata_id'], *f) for r, f in _STAGED], 'socrata_id, ' + ', '.join(_FLAGS))}")
def _(spark, d):
    rows = C.clean(_staged(spark))
    out = rows
    for nk, members in D.members(rows).values():
        out = out.join(members.select(nk, *(n for n in members.columns if n in _FLAGS)).distinct(), nk)
    return out.select("socrata_id", *_FLAGS)


@query("hash_input", "SELECT socrata_id, CAST(to_json(struct_pack(" + ", ".join(f"{n} := CAST({n} AS VARCHAR)" for n in C.HASHED) + f")) AS VARCHAR) AS row_json FROM {values_sql([(r['socrata_id'], *(r.get(n) for n in C.HASHED)) for r, _ in _STAGED], 'socrata_id, ' + ', '.join(C.HASHED))}")
def _(spark, d):
    return C.clean(_staged(spark)).select("socrata_id", "row_json")


@query("typo_fix", "SELECT * FROM (VALUES ('a', 'DARK - LIGHTED ROADWAY'), ('b', 'DAYLIGHT'), ('c', 'UNKNOWN'), ('d', 'DARK - ROADWAY NOT LIGHTED'), ('e', 'DUSK')) AS v(socrata_id, light_lbl)")
def _(spark, d):
    return C.clean(_staged(spark)).select("socrata_id", "light_lbl")


_INITS = [("FOUR-WAY INTERSECTION", "Four-Way Intersection"), ("ON RAMP/OFF RAMP", "On Ramp/Off Ramp"), ("NOT AN INTERSECTION", "Not An Intersection"), ("O'BRIEN 5TH", "O'Brien 5th"), ("", ""), (None, None)]


@query("initcap_words", f"SELECT raw, label FROM {values_sql(_INITS, 'raw, label')}")
def _(spark, d):
    return values(spark, [(a,) for a, _ in _INITS], "raw string").select("raw", S.word_initcap(c("raw")).alias("label"))


_TIMES = ["2026-01-02T03:04:05.000", "2026-01-02 03:04:05", "2026-01-02", "bad", "", "2026", "2026-01", "2026-13-01", None]


@query("safe_cast_datetime", f"SELECT raw, TRY_CAST(CASE WHEN regexp_matches(raw, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN raw END AS TIMESTAMP) AS at FROM {values_sql([(x,) for x in _TIMES], 'raw')}")
def _(spark, d):
    return values(spark, [(x,) for x in _TIMES], "raw string").select("raw", S.safe_datetime(c("raw")).alias("at"))


_PAIRS = [("39.10", "-84.51"), ("39.10", None), ("39.10", "0"), ("0", "-84.51"), ("x", "-84.51"), ("38.9", "-84.9"), ("39.4", "-84.2"), (None, None)]


@query("pair_bounds", f"WITH v AS (SELECT la, lo, TRY_CAST(la AS DOUBLE) AS a, TRY_CAST(lo AS DOUBLE) AS b FROM {values_sql(_PAIRS, 'la, lo')}) SELECT la, lo, CASE WHEN a BETWEEN 38.9 AND 39.4 AND b BETWEEN -84.9 AND -84.2 THEN a END AS latitude, CASE WHEN a BETWEEN 38.9 AND 39.4 AND b BETWEEN -84.9 AND -84.2 THEN b END AS longitude FROM v")
def _(spark, d):
    v = values(spark, _PAIRS, "la string, lo string")
    a, b = S.bounded_pair(S.safe_double(c("la")), S.safe_double(c("lo")), C.BOX)
    return v.select("la", "lo", a.alias("latitude"), b.alias("longitude"))


_PARTS = [("a", "b", "c"), ("a", None, "c"), (None, None, None), ("", "b", "")]


@query("natural_keys", f"SELECT x, y, z, coalesce(x, '~') || '|' || coalesce(y, '~') || '|' || coalesce(z, '~') AS nk, md5(coalesce(x, '~') || '|' || coalesce(y, '~')) AS hashed FROM {values_sql(_PARTS, 'x, y, z')}")
def _(spark, d):
    return values(spark, _PARTS, "x string, y string, z string").select("x", "y", "z", S.natural_key(c("x"), c("y"), c("z")).alias("nk"), F.md5(S.natural_key(c("x"), c("y"))).alias("hashed"))


_RANGES = [("15 or Under", "00-15", 1), (" 16-19 ", "16-19", 2), ("75+", "75+", 9), ("BB", "Unknown", 99), ("Unknown", "Unknown", 99), (None, "Unknown", 99)]


@query("age_ranges", f"SELECT raw, label, sort FROM {values_sql(_RANGES, 'raw, label, sort')}")
def _(spark, d):
    v = values(spark, [(r[0],) for r in _RANGES], "raw string").withColumn("label", L.age_range(c("raw")))
    return v.select("raw", "label", L.age_sort(c("label")).alias("sort"))


_AGES = [(15, "00-15"), (16, "16-19"), (19, "16-19"), (20, "20-24"), (24, "20-24"), (25, "25-34"), (64, "55-64"), (75, "75+"), (None, "Unknown")]


@query("age_bands", f"SELECT age, label FROM {values_sql(_AGES, 'age, label')}")
def _(spark, d):
    return values(spark, [(a,) for a, _ in _AGES], "age int").select("age", L.age_band(c("age")).alias("label"))


_ERAS = [(None, "Unknown"), (dt.datetime(2018, 12, 31, 23, 59), "Pre-2019"), (dt.datetime(2019, 1, 1), "2019+")]


@query("coding_era", f"SELECT moment, era FROM {values_sql(_ERAS, 'moment, era')}")
def _(spark, d):
    return values(spark, [(a,) for a, _ in _ERAS], "moment timestamp_ntz").select("moment", L.coding_era(c("moment")).alias("era"))


_MINUTES = [(dt.datetime(2026, 1, 1, 10, 0, 59), dt.datetime(2026, 1, 1, 10, 1, 0)), (dt.datetime(2026, 1, 1, 10, 0), dt.datetime(2026, 1, 1, 9, 30)), (dt.datetime(2026, 1, 1, 10, 0), None)]


@query("minute_boundaries", f"SELECT a, b, date_diff('minute', a, CAST(b AS TIMESTAMP)) / 60.0 AS hours FROM {values_sql(_MINUTES, 'a, b')}")
def _(spark, d):
    return values(spark, _MINUTES, "a timestamp_ntz, b timestamp_ntz").select("a", "b", (S.minute_boundaries(c("a"), c("b")) / 60.0).alias("hours"))


@query("scalar_semantics", "SELECT * FROM (VALUES ('a', CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), 'N A'), ('b', 2.5, 5, NULL)) AS v(k, ratio, largest, cell)")
def _(spark, d):
    v = values(spark, [("a", 1.0, 0.0, None, 5, " n a\t"), ("b", 5.0, 2.0, 3, 5, "n/a")], "k string, x double, y double, p int, q int, raw string")
    return v.select("k", S.safe_div(c("x"), c("y")).alias("ratio"), S.null_greatest(c("p"), c("q")).alias("largest"), S.cell_name(S.ws_trim(c("raw"))).alias("cell"))


# ---------------------------------------------------------------- reports and guards


@query("grain_report", """WITH k AS (SELECT l_returnflag AS source, l_orderkey, count(DISTINCT CAST(l_shipdate AS DATE)) > 1 AS multi FROM lineitem GROUP BY 1, 2)
 SELECT f.l_returnflag AS source_dataset, count(*) AS fact_rows, count(DISTINCT f.l_orderkey) AS distinct_crashes, round(count(*) / count(DISTINCT f.l_orderkey), 3) AS persons_per_crash, count(DISTINCT CASE WHEN multi THEN f.l_orderkey END) AS multi_date_crashes,
 count(*) - count(DISTINCT f.l_partkey) AS repeated_socrata_ids, count(DISTINCT CASE WHEN l_linestatus = 'O' THEN f.l_orderkey END) AS crashes_without_neighborhood, max(CAST(l_shipdate AS DATE)) AS newest_crash_date
 FROM lineitem f JOIN k ON k.source = f.l_returnflag AND k.l_orderkey = f.l_orderkey GROUP BY 1""")
def _(spark, d):
    f = t(spark, d, "lineitem").select(c("l_returnflag").alias("source_dataset"), c("l_orderkey").alias("instanceid"), day("l_shipdate").alias("crash_date"), c("l_partkey").alias("socrata_id"), F.when(c("l_linestatus") != "O", c("l_linestatus")).alias("neighborhood"))
    return reports.grain(f)


@query("unknown_members_report", "SELECT count(*) FILTER (WHERE l_partkey % 10 = 0) AS unknown_locations, count(*) FILTER (WHERE l_suppkey % 10 = 0) AS unknown_conditions FROM lineitem")
def _(spark, d):
    f = t(spark, d, "lineitem").select(F.when(c("l_partkey") % 10 == 0, -1).otherwise(1).alias("location_key"), F.when(c("l_suppkey") % 10 == 0, -1).otherwise(1).alias("conditions_key"))
    return reports.fall_through(f, {"location_key": ("unknown_locations", -1), "conditions_key": ("unknown_conditions", -1)})


@query("era_split", "SELECT l_linestatus AS coding_era, count(*) AS person_rows, CAST(sum(CAST(l_returnflag = 'R' AS BIGINT)) AS BIGINT) AS fatalities, round(100 * sum(CAST(l_quantity > 25 AS BIGINT)) / count(*), 2) AS pct_injured FROM lineitem GROUP BY 1")
def _(spark, d):
    f = t(spark, d, "lineitem").select(c("l_linestatus").alias("coding_era"), long(c("l_returnflag") == "R").alias("is_fatal"), long(c("l_quantity") > 25).alias("is_injured"))
    return reports.era_split(f)


_NOW = dt.datetime(2026, 10, 20, 12, 0)
_LOG = [("a", "succeeded", dt.datetime(2026, 10, 18, 6, 0), "2026-09-20T00:00:00.000Z"), ("b", "failed", dt.datetime(2026, 10, 20, 6, 0), None), ("c", "succeeded", dt.datetime(2026, 10, 19, 6, 0), "2026-09-28T00:00:00.000Z")]


@query("watchdog_guards", "SELECT * FROM (VALUES ('lock held for over 2 hours'), ('no load succeeded in 24 hours'), ('publish stamp is over 21 days old')) AS v(problem)")
def _(spark, d):
    log = values(spark, _LOG, "load_id string, status string, finished_at timestamp_ntz, socrata_updated_at string")
    lease = values(spark, [("x", dt.datetime(2026, 10, 20, 9, 0))], "holder string, heartbeat_at timestamp_ntz")
    days = values(spark, [(dt.date(2026, 10, 1),)], "crash_date date")
    return monitor.problems(lease, log, days, _NOW)


@query("watchdog_quiet", "SELECT 'x' AS problem WHERE false")
def _(spark, d):
    log = values(spark, [("a", "succeeded", dt.datetime(2026, 10, 20, 6, 0), "2026-10-15T00:00:00.000Z")], "load_id string, status string, finished_at timestamp_ntz, socrata_updated_at string")
    return monitor.problems(values(spark, [], "holder string, heartbeat_at timestamp_ntz"), log, values(spark, [(dt.date(2026, 10, 1),)], "crash_date date"), _NOW)


@query("watchdog_old_fact", "SELECT 'newest crash is over 60 days old' AS problem")
def _(spark, d):
    log = values(spark, [("a", "succeeded", dt.datetime(2026, 10, 20, 6, 0), "2026-10-15T00:00:00.000Z")], "load_id string, status string, finished_at timestamp_ntz, socrata_updated_at string")
    return monitor.problems(values(spark, [], "holder string, heartbeat_at timestamp_ntz"), log, values(spark, [(dt.date(2026, 8, 20),), (None,)], "crash_date date"), _NOW)


_CAPS = [(100, 5, False, False), (101, 5, False, True), (101, 5, True, False), (300, 30_000, False, False), (301, 30_000, False, True), (0, 0, False, False)]


@query("deletion_cap", f"SELECT removed, deletable, allowed, aborted FROM {values_sql(_CAPS, 'removed, deletable, allowed, aborted')}")
def _(spark, d):
    def aborted(*case):
        try:
            X.check_cap(*case)
        except LoadAborted:
            return True
        return False

    return values(spark, [(*k[:3], aborted(*k[:3])) for k in _CAPS], "removed int, deletable int, allowed boolean, aborted boolean")


@query("watermark", "SELECT max(CAST(o_orderdate AS DATE)) - 90 AS window_start FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2000-01-01'")
def _(spark, d):
    from starpanel.plans.load import watermark

    f = t(spark, d, "orders").select(day().alias("crash_date"), F.lit(C.OWNED).alias("source_dataset"), F.lit(None).cast("string").alias("neighborhood"))
    start, _ = watermark(f, dt.date(2000, 1, 1))
    return spark.range(1).select(F.lit(start).alias("window_start"))
