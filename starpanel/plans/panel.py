"""The cell x day panel: a dense grid, features from strictly earlier days, a label from the seven days ahead."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpanel.functions.semantics import cell_name, distance_m, matches_prior
from starpanel.operators.checks import repeated, require, require_none
from starpanel.operators.dims import calendar
from starpanel.operators.fact import ANCHOR
from starpanel.operators.holidays import holidays

SCHEMES = ("neighborhood", "cpd_neighborhood", "sna_neighborhood", "community_council_neighborhood")
WEATHER = ("tmax_f", "tmin_f", "prcp_in", "snow_in", "snwd_in", "awnd_mph")
ATTRIBUTES = ("road_miles", "intersection_count", "aadt", "population")


@dataclass(frozen=True)
class PanelConfig:
    scheme: str = "neighborhood"
    start: dt.date = dt.date(2016, 1, 1)
    buffer_days: int = 7
    valid_start: dt.date = dt.date(2024, 1, 1)
    test_start: dt.date = dt.date(2025, 1, 1)
    hours_in_cell: int = 24
    min_events: int = 100
    anchor: tuple[float, float] = ANCHOR


def panel_end(days: DataFrame, today: dt.date, buffer_days: int) -> dt.date:
    """The last day of the panel: days (column day) up to today, less the buffer in which reports still come in."""
    newest = days.where(F.col("day") <= F.lit(today)).agg(F.max("day")).first()[0]
    require(newest is not None, "No dated event: the panel has no end.")
    return newest - dt.timedelta(days=buffer_days)


def crash_cells(fact: DataFrame, locations: DataFrame, config: PanelConfig, end: dt.date) -> DataFrame:
    """(event, day, cell_id): each crash once, by the largest of its rows' days and cells."""
    require(config.scheme in SCHEMES, f"The scheme must be one of {SCHEMES}.")
    f = fact.where(F.col("crash_date").between(F.lit(config.start), F.lit(end)))
    if config.scheme != SCHEMES[0]:
        f = f.drop(config.scheme).join(locations.select("location_key", config.scheme), "location_key")
    return f.groupBy(F.col("instanceid").alias("event")).agg(F.max("crash_date").alias("day"), F.max(cell_name(F.col(config.scheme))).alias("cell_id"))


def eligible_cells(events: DataFrame, least: int) -> DataFrame:
    return events.where(F.col("cell_id").isNotNull()).groupBy("cell_id").agg(F.count("*").alias("events")).where(F.col("events") >= least)


def cell_distance(points: DataFrame, anchor: tuple[float, float] = ANCHOR) -> DataFrame:
    """(cell_id, distance_to_cbd_km): of the median longitude and latitude of a cell's points (cell_id, longitude, latitude)."""
    p = points.where("cell_id IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL")
    median = lambda c: F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})")
    at = p.groupBy("cell_id").agg(median("longitude").alias("lon"), median("latitude").alias("lat"))
    return at.select("cell_id", F.round(distance_m(F.col("lon"), F.col("lat"), *anchor, digits=6) / 1000, 3).alias("distance_to_cbd_km"))


def grid(cells: DataFrame, events: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """(cell_id, day, crashes): every cell on every day, zero where nothing happened.

    Each cell's days are generated where the cell is, so no table of days is sent or joined.
    """
    counts = events.where(F.col("cell_id").isNotNull()).groupBy("cell_id", "day").agg(F.count("*").alias("n"))
    spine = cells.select("cell_id", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    return spine.join(counts, ["cell_id", "day"], "left").select("cell_id", "day", F.coalesce("n", F.lit(0)).cast("long").alias("crashes"))


def lag_features(g: DataFrame, end: dt.date) -> DataFrame:
    """Label and lags; one exchange and one sort by cell serve all frames."""
    w, x = Window.partitionBy("cell_id").orderBy("day"), F.col("crashes")
    w28, w91, ahead = w.rowsBetween(-28, -1), w.rowsBetween(-91, -1), w.rowsBetween(1, 7)
    return g.select(
        "*", F.when(F.col("day") <= F.lit(end - dt.timedelta(days=7)), F.sum(x).over(ahead)).alias("crashes_next_7"),
        F.lag(x, 7).over(w).alias("lag_7"), F.lag(x, 364).over(w).alias("lag_364"),
        F.when(F.count("*").over(w28) >= 14, F.avg(x).over(w28)).alias("roll_28"), F.when(F.count("*").over(w91) >= 30, F.avg(x).over(w91)).alias("roll_91"),
    )


def calendar_features(p: DataFrame, config: PanelConfig, end: dt.date) -> DataFrame:
    spark = p.sparkSession
    day, turn = F.col("day"), F.lit(2.0) * F.acos(F.lit(-1.0)) * F.dayofyear("day") / 365.25
    free = holidays(spark, config.start.year - 1, end.year + 1).select(F.col("day").alias("__h"))
    p = p.join(free, day == F.col("__h"), "left").select(*p.columns, F.col("__h").isNotNull().alias("is_holiday"))
    return p.select(
        *[c for c in p.columns if c != "is_holiday"], F.dayofweek(day).cast("long").alias("dow"), F.month(day).cast("long").alias("month"), F.dayofweek(day).isin(1, 7).alias("is_weekend"), "is_holiday",
        F.sin(turn).alias("doy_sin"), F.cos(turn).alias("doy_cos"),
    )


def exposure_columns(hours: int) -> tuple[Column, Column, Column]:
    a, m = F.col("aadt"), F.col("road_miles")
    value = F.coalesce(a, F.lit(1.0)) * F.coalesce(m, F.lit(1.0)) * hours
    form = F.when(a.isNotNull() & m.isNotNull(), "aadt_x_road_miles_x_hours").when(m.isNotNull(), "road_miles_x_hours").when(a.isNotNull(), "aadt_x_hours").otherwise("hours_only")
    return value, F.ln(value), form


def split_label(config: PanelConfig) -> Column:
    day = F.col("day")
    return F.when(day < F.lit(config.valid_start), "train").when(day < F.lit(config.test_start), "valid").otherwise("test")


def build(events: DataFrame, points: DataFrame, config: PanelConfig, end: dt.date, weather: DataFrame, attributes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The panel and its cells, from events (event, day, cell_id) and points (cell_id, longitude, latitude)."""
    cells = eligible_cells(events, config.min_events)
    p = calendar_features(lag_features(grid(cells, events, config.start, end), end), config, end)
    p = p.join(weather.select("day", *WEATHER), "day", "left")
    own = attributes.where(F.col("cell_scheme") == config.scheme).select("cell_id", *ATTRIBUTES)
    p = p.join(own, "cell_id", "left").join(cell_distance(points, config.anchor), "cell_id", "left")
    value, log, form = exposure_columns(config.hours_in_cell)
    p = p.select(
        F.lit(config.scheme).alias("cell_scheme"), "cell_id", "day", "crashes", "crashes_next_7", "lag_7", "lag_364", "roll_28", "roll_91", "dow", "month", "is_weekend", "is_holiday", "doy_sin", "doy_cos",
        *WEATHER, *ATTRIBUTES, "distance_to_cbd_km", value.alias("exposure"), log.alias("log_exposure"), form.alias("exposure_source"), split_label(config).alias("split"),
    )
    return p, cells


def label_mismatches(p: DataFrame) -> DataFrame:
    """Rows whose label isn't the sum of the next seven days of their own cell: each day is given to the seven before it."""
    given = p.select("cell_id", "crashes", "day", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("k")).select("cell_id", F.expr("date_sub(day, k)").alias("day"), "crashes")
    again = given.groupBy(F.col("cell_id").alias("c"), F.col("day").alias("d")).agg(F.sum("crashes").alias("next_7"), F.count("*").alias("n")).where("n = 7")
    return p.join(again, (p.cell_id == again.c) & (p.day == again.d), "left").where(~F.col("crashes_next_7").eqNullSafe(F.col("next_7"))).select("cell_id", "day")


#: Days of a cell that one key holds; no window of the lag features is longer.
SPAN = 91


def recomputed_lags(p: DataFrame) -> DataFrame:
    """Lag features of every row, from strictly earlier days only.

    Days meet by cell and span: a day looks back into its own span and the one before it, so that a key holds two spans
    of one cell, however long the panel is.
    """
    span = F.floor(F.datediff("day", F.lit("1970-01-01").cast("date")) / SPAN)
    rows = p.select("cell_id", F.col("day").alias("at"), span.alias("span"))
    past = p.select("cell_id", "day", "crashes", F.explode(F.array(span, span + 1)).alias("span"))
    ago = F.datediff("at", "day")
    seen = rows.join(past, ["cell_id", "span"]).where(ago.between(1, SPAN)).withColumn("ago", ago)
    within = lambda days: F.when(F.col("ago") <= days, F.col("crashes"))
    mean = lambda days, least: F.when(F.count(within(days)) >= least, F.avg(within(days)))
    lags = seen.groupBy("cell_id", F.col("at").alias("day")).agg(
        F.max(F.when(F.col("ago") == 7, F.col("crashes"))).alias("lag_7"), mean(28, 14).alias("roll_28"), mean(91, 30).alias("roll_91")
    )
    year = p.select("cell_id", F.date_add("day", 364).alias("day"), F.col("crashes").alias("lag_364"))
    out = p.select("cell_id", "day").join(lags, ["cell_id", "day"], "left").join(year, ["cell_id", "day"], "left")
    return out.select("cell_id", "day", "lag_7", "lag_364", "roll_28", "roll_91")


def leaks(p: DataFrame) -> DataFrame:
    """Rows with a lag feature that their strictly earlier days don't give."""
    names = ("lag_7", "lag_364", "roll_28", "roll_91")
    r = recomputed_lags(p).select(F.col("cell_id").alias("__c"), F.col("day").alias("__d"), *(F.col(n).alias(f"__{n}") for n in names))
    bad = F.lit(False)
    for n in names:
        bad = bad | ~matches_prior(F.col(n), F.col(f"__{n}"))
    return p.join(r, (p.cell_id == r["__c"]) & (p.day == r["__d"]), "left").where(bad).select("cell_id", "day")


def check_inputs(weather: DataFrame, attributes: DataFrame) -> None:
    require_none(repeated(weather, "day"), "Duplicate weather day.")
    require_none(repeated(attributes, "cell_scheme", "cell_id"), "Duplicate cell attribute key.")


def check_panel(p: DataFrame, cells: DataFrame, config: PanelConfig, end: dt.date) -> None:
    n_cells, events = cells.agg(F.count("*"), F.sum("events")).first()
    require(n_cells > 0, "No cell has enough history.")
    got = p.agg(
        F.sum("crashes").alias("total"), F.count("*").alias("n"), F.count_distinct("cell_id", "day").alias("distinct"), F.count_if(F.col("crashes_next_7").isNull()).alias("open"),
        F.count_if(F.col("distance_to_cbd_km").isNull()).alias("nowhere"), F.count_distinct("exposure_source").alias("forms"), F.count_if(~F.coalesce(F.col("exposure") > 0, F.lit(False))).alias("no_exposure"), F.count_if(F.col("crashes") == 0).alias("zero"),
    ).first()
    require(got.nowhere == 0, "A panel cell has no usable coordinates.")
    require(got.total == events, "The panel's crashes are not those of its cells.")
    require(got.n == n_cells * ((end - config.start).days + 1), "The panel is not cells x days.")
    require(got.n == got.distinct, "Duplicate (cell, day) rows.")
    require(got.open == 7 * n_cells, "Rows without a label are not the last seven days of each cell.")
    require_none(label_mismatches(p), "A label is not the next seven days of its own cell.")
    require_none(leaks(p), "Leakage: a lag feature does not match its strictly prior recomputation.")
    require(got.forms == 1, "Rows mix exposure forms.")
    require(got.no_exposure == 0, "Exposure must be positive.")
    require(got.zero / got.n < 0.95, "Zero fraction of 95% or more: the grain is too fine.")


def poisson_deviance(p: DataFrame, actual: str, expected: str) -> DataFrame:
    """Mean Poisson deviance of a forecast, as one row."""
    y, mu = F.col(actual).cast("double"), F.greatest(F.col(expected), F.lit(1e-9))
    return p.where(F.col(actual).isNotNull() & F.col(expected).isNotNull()).agg(F.avg(2 * (F.when(y > 0, y * F.ln(y / mu)).otherwise(0.0) - (y - mu))).alias("deviance"))


def predictive_accuracy_index(p: DataFrame, actual: str, score: str, share: float = 0.01) -> DataFrame:
    """Share of events in the top-scored rows over the share of rows that these are, as one row."""
    n = p.count()
    top = max(1, int(n * share))
    best = p.where(F.col(score).isNotNull()).orderBy(F.desc(score), "cell_id", "day").limit(top).agg(F.sum(actual).alias("hit"))
    total = p.agg(F.sum(actual).alias("all"))
    return best.join(total).select((F.try_divide(F.col("hit"), F.col("all")) / (top / n)).alias("pai"))
