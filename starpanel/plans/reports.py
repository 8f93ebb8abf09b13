"""Quality reports on the fact and the panel; each is a plan, ``show`` prints any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def show(title: str, df: DataFrame, limit: int = 1000) -> list[str]:
    """A report's rows as lines; reports are small by construction."""
    lines = [title, *(" | ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in df.limit(limit).collect())]
    print("\n".join(lines))
    return lines


def fall_through(fact: DataFrame, keys: dict[str, tuple[str, int]]) -> DataFrame:
    """How many rows have each key's unknown member."""
    return fact.agg(*(F.count_if(c(k) == unknown).alias(name) for k, (name, unknown) in keys.items()))


def grain(fact: DataFrame) -> DataFrame:
    """Rows, crashes and oddities per source. Crashes are collapsed once; one has several dates if its first isn't its
    last, which takes no row for each of its dates."""
    per = fact.groupBy("source_dataset", "instanceid").agg(
        F.min("crash_date").alias("oldest"), F.max("crash_date").alias("newest"), F.count("*").alias("n"), F.count_if(c("neighborhood").isNull()).alias("blank"))
    out = per.groupBy("source_dataset").agg(
        F.sum("n").alias("fact_rows"), F.count("*").alias("distinct_crashes"), F.round(F.try_divide(F.sum("n"), F.count("*")), 3).alias("persons_per_crash"),
        F.count_if(c("oldest") < c("newest")).alias("multi_date_crashes"), F.count_if(c("blank") > 0).alias("crashes_without_neighborhood"), F.max("newest").alias("newest_crash_date"))
    ids = fact.groupBy("source_dataset").agg(F.count_distinct("socrata_id").alias("ids"))
    return out.join(ids, "source_dataset").select(
        "source_dataset", "fact_rows", "distinct_crashes", "persons_per_crash", "multi_date_crashes", (c("fact_rows") - c("ids")).alias("repeated_socrata_ids"), "crashes_without_neighborhood", "newest_crash_date")


def source_quality(fact: DataFrame) -> DataFrame:
    lag = c("reporting_lag_hours")
    return fact.groupBy("source_dataset").agg(
        F.count_if(c("age").isNull()).alias("null_or_invalid_age"), F.count_if(c("age_range") == "Unknown").alias("unknown_age_range"), F.count_if(c("crash_datetime").isNull()).alias("unparseable_crash_datetime"),
        F.count_if(lag < 0).alias("reported_before_crash"), F.count_if(lag > 24 * 30).alias("reported_over_30_days_later"))


def coverage(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(attribute, value, n): values of several tables' columns, one under the other."""
    out = None
    for name, (df, column) in parts.items():
        rows = df.groupBy(c(column).alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("attribute"), "value", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


def era_split(fact: DataFrame) -> DataFrame:
    return fact.groupBy("coding_era").agg(F.count("*").alias("person_rows"), F.sum("is_fatal").alias("fatalities"), F.round(100 * F.try_divide(F.sum("is_injured"), F.count("*")), 2).alias("pct_injured"))


def panel_summary(p: DataFrame) -> DataFrame:
    x = c("crashes")
    return p.agg(F.count("*").alias("n_rows"), F.count_distinct("cell_id").alias("cells"), F.sum(x).alias("crashes"), F.round(F.avg(x), 9).alias("mean"),
                 F.round(F.try_divide(F.count_if(x == 0), F.count("*")), 9).alias("zero_fraction"), F.round(F.try_divide(F.var_samp(x), F.avg(x)), 9).alias("dispersion"))


def split_summary(p: DataFrame) -> DataFrame:
    return p.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("crashes").alias("crashes"), F.round(F.avg("crashes"), 9).alias("mean"))


def nearest_farthest(distances: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest and the k farthest cells; top-k of both ends, without one task for all cells."""
    d = distances.select("cell_id", c("distance_to_cbd_km").alias("km"))
    near = d.orderBy("km", "cell_id").limit(k).withColumn("side", F.lit("nearest"))
    far = d.orderBy(F.desc("km"), "cell_id").limit(k).withColumn("side", F.lit("farthest")).join(near.select("cell_id"), "cell_id", "left_anti")
    return near.unionByName(far)


def placement_disagreement(fact: DataFrame, event: str, schemes: dict[str, Column]) -> DataFrame:
    """(scheme, events): events whose rows are placed in several cells of a scheme."""
    placed = fact.select(event, F.explode(F.array(*(F.struct(F.lit(n).alias("scheme"), v.alias("cell")) for n, v in schemes.items()))).alias("__s")).select(event, "__s.*")
    return placed.groupBy("scheme", event).agg(F.count_distinct("cell").alias("n")).where("n > 1").groupBy("scheme").agg(F.count("*").alias("events"))


def held_out(events: DataFrame, cells: DataFrame) -> DataFrame:
    """(cell_id, events): cells that the history threshold leaves out."""
    n = events.where(c("cell_id").isNotNull()).groupBy("cell_id").agg(F.count("*").alias("events"))
    return n.join(cells.select("cell_id"), "cell_id", "left_anti")
