"""The fact: snapshot, content hashes, change classification, replacement by crash and the proofs on the outcome."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpanel.functions.semantics import content_hash, distance_m, minute_boundaries, null_if_blank, unanimous
from starpanel.operators.checks import LoadAborted, repeated, require_none
from starpanel.operators.clean import FROZEN, OWNED
from starpanel.operators.dims import UNKNOWN, UNKNOWN_DATE
from starpanel.schema import conform

#: Longitude and latitude that distances are measured to.
ANCHOR = (-84.5125, 39.1011)
CAP_ROWS, CAP_SHARE = 100, 0.01


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def snapshot(cleaned: DataFrame) -> DataFrame:
    """One row per id (its newest version); rows of drivers that repeat exactly are dropped, other people never are."""
    one = latest(cleaned, ["socrata_id"], [F.desc("socrata_version")])
    w = Window.partitionBy("row_json").orderBy("socrata_id")
    return one.withColumn("__rn", F.row_number().over(w)).where((F.col("type_of_person") != "Driver") | (F.col("__rn") == 1)).drop("__rn")


def crash_hashes(people: DataFrame) -> DataFrame:
    return people.groupBy("instanceid").agg(content_hash(F.col("row_json")).alias("crash_hash"), F.count("*").alias("person_rows"))


def fact_state(owned: DataFrame, window_start: dt.date | None) -> DataFrame:
    """Per crash of the fact: its hash if unanimous, its rows, and whether it lies before or in the window."""
    day = F.col("crash_date")
    if window_start is None:
        before, inside = F.lit(False), F.lit(True)
    else:
        start = F.lit(window_start)
        before, inside = F.count_if(day.isNull() | (day < start)) > 0, F.count_if(day >= start) > 0
    return owned.groupBy("instanceid").agg(unanimous(F.col("crash_hash")).alias("crash_hash"), F.count("*").alias("person_rows"), before.alias("before_window"), inside.alias("in_window"))


def differing(staged: DataFrame, state: DataFrame, reprocess: bool = False) -> DataFrame:
    """(instanceid, crash_hash, is_new, deferred): staged crashes that the fact holds otherwise; those that reach back
    before the window are deferred, not judged."""
    f = state.select(F.col("instanceid").alias("__id"), F.col("crash_hash").alias("__hash"), F.col("person_rows").alias("__rows"), "before_window")
    new = F.col("__id").isNull()
    j = staged.join(f, staged.instanceid == f["__id"], "left")
    if not reprocess:  # decided here, not in the plan: a flag in the predicate would keep the join from being pruned
        j = j.where(new | ~F.col("__hash").eqNullSafe(F.col("crash_hash")) | (F.col("__rows") != F.col("person_rows")))
    return j.select("instanceid", "crash_hash", new.alias("is_new"), F.coalesce("before_window", F.lit(False)).alias("deferred"))


def removed(staged: DataFrame, state: DataFrame) -> DataFrame:
    return state.where(F.col("in_window") & ~F.col("before_window")).join(staged, "instanceid", "left_anti").select("instanceid")


def check_cap(n_removed: int, deletable: int, allowed: bool) -> None:
    if n_removed > max(CAP_ROWS, CAP_SHARE * deletable) and not allowed:
        raise LoadAborted(f"This load would delete {n_removed} crashes that the feed no longer has, over the cap of max({CAP_ROWS}, {CAP_SHARE:.0%} of the crashes it could delete).")


def _lookup(rows: DataFrame, dim: DataFrame, on: Column, key: str, unknown: int, name: str) -> DataFrame:
    return rows.join(dim, on, "left").withColumn(name, F.coalesce(F.col(key), F.lit(unknown)))


def fact_rows(people: DataFrame, changed: DataFrame, dims: dict[str, DataFrame], anchor: tuple[float, float] = ANCHOR) -> DataFrame:
    """Rows of changed crashes with their keys; what no dimension knows gets the unknown member."""
    c = F.col
    v = people.join(changed.select("instanceid", "crash_hash"), "instanceid")
    day = dims["dim_date"].select("full_date", "date_key")
    v = _lookup(v, day.select(c("full_date").alias("__d1"), c("date_key").alias("__k1")), c("crash_datetime").cast("date") == c("__d1"), "__k1", UNKNOWN_DATE, "crash_date_key")
    v = _lookup(v, day.select(c("full_date").alias("__d2"), c("date_key").alias("__k2")), c("reported_datetime").cast("date") == c("__d2"), "__k2", UNKNOWN_DATE, "reported_date_key")
    at = F.hour("crash_datetime") * 100 + F.minute("crash_datetime")
    v = _lookup(v, dims["dim_time"].select(c("time_key").alias("__t")), at == c("__t"), "__t", UNKNOWN, "crash_time_key")
    for name in ("location", "conditions", "crash_type", "person_profile"):
        d = dims[f"dim_{name}"].select(c(f"{name}_nk").alias(f"__{name}_nk"), c(f"{name}_key").alias(f"__{name}_key"))
        v = _lookup(v, d, c(f"{name}_nk") == c(f"__{name}_nk"), f"__{name}_key", UNKNOWN, f"{name}_key")
    return conform(v.select(
        "*", c("crash_datetime").cast("date").alias("crash_date"), (minute_boundaries(c("crash_datetime"), c("reported_datetime")) / 60.0).alias("reporting_lag_hours"),
        distance_m(c("longitude"), c("latitude"), *anchor).alias("distance_to_cbd_m"), F.lit(1).alias("person_count"),
        (c("injury_severity_rank") >= 2).cast("long").alias("is_injured"), (c("injury_severity_rank") == 5).cast("long").alias("is_fatal"), F.current_timestamp().alias("loaded_at"),
    ), "fact_crash_person")


def replaced(fact: DataFrame, changed: DataFrame, gone: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The fact without the owned rows of changed and removed crashes, with the new rows."""
    out = changed.select("instanceid").union(gone.select("instanceid")).distinct()
    owned = fact.where(F.col("source_dataset") == OWNED).join(out, "instanceid", "left_anti").select(*fact.columns)
    return fact.where(F.col("source_dataset") != OWNED).unionByName(owned).unionByName(new_rows)


def touched_months(fact: DataFrame, changed: DataFrame, gone: DataFrame, new_rows: DataFrame, names: DataFrame) -> set[dt.date | None]:
    """The months in which a load changes any row: those of the rows that go, of those that come, and of the names it fills."""
    month = F.trunc("crash_date", "MM").alias("month")
    out = changed.select("instanceid").union(gone.select("instanceid"))
    going = fact.where(F.col("source_dataset") == OWNED).join(out, "instanceid", "left_semi")
    filled = fact.where((F.col("source_dataset") == FROZEN) & F.col("neighborhood").isNull()).join(names.where(F.col("neighborhood").isNotNull()), "localreportno", "left_semi")
    return {r.month for r in going.select(month).union(new_rows.select(month)).union(filled.select(month)).distinct().collect()}


def history_names(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """(localreportno, neighborhood) of staged crashes that the frozen history has."""
    old = fact.where(F.col("source_dataset") == FROZEN).select("localreportno").distinct()
    s = staging.select(F.col("reportnumber").alias("localreportno"), null_if_blank(F.col("snaneighborhood")).alias("neighborhood"))
    return s.join(old, "localreportno", "left_semi").groupBy("localreportno").agg(F.max("neighborhood").alias("neighborhood"))


def fill_history(fact: DataFrame, names: DataFrame) -> DataFrame:
    """Frozen rows gain a neighborhood where they have none; nothing else about them changes."""
    n = names.select(F.col("localreportno").alias("__r"), F.col("neighborhood").alias("__n"))
    fill = (F.col("source_dataset") == FROZEN) & F.col("neighborhood").isNull()
    return fact.join(n, fact.localreportno == n["__r"], "left").withColumn("neighborhood", F.when(fill, F.col("__n")).otherwise(F.col("neighborhood"))).drop("__r", "__n")


@dataclass(frozen=True)
class Classified:
    people: DataFrame
    staged: DataFrame
    state: DataFrame
    differing: DataFrame
    changed: DataFrame
    removed: DataFrame


def classify(people: DataFrame, owned: DataFrame, window_start: dt.date | None, reprocess: bool = False) -> Classified:
    staged, state = crash_hashes(people), fact_state(owned, window_start)
    diff = differing(staged, state, reprocess)
    return Classified(people, staged, state, diff, diff.where(~F.col("deferred")), removed(staged, state))


def post_image_checks(fact: DataFrame, before: DataFrame, c: Classified) -> None:
    """What must hold of the new fact before it is published."""
    frozen = lambda f: f.where(F.col("source_dataset") == FROZEN).count()
    if frozen(fact) != frozen(before):
        raise LoadAborted("The load changed the number of frozen history rows.")
    new = fact.where(F.col("source_dataset") == OWNED).join(c.changed.select("instanceid"), "instanceid", "left_semi")
    require_none(new.where(F.lit(UNKNOWN).isin(*(F.col(k) for k in ("location_key", "conditions_key", "crash_type_key", "person_profile_key")))), "A new fact row fell through to an unknown member.")
    state = fact_state(fact.where(F.col("source_dataset") == OWNED), None).select(F.col("instanceid").alias("__id"), F.col("crash_hash").alias("__h"), F.col("person_rows").alias("__n"))
    judged = c.staged.join(c.differing.where("deferred").select("instanceid"), "instanceid", "left_anti")
    wrong = judged.join(state, judged.instanceid == state["__id"], "left").where(~F.col("__h").eqNullSafe(F.col("crash_hash")) | ~F.col("__n").eqNullSafe(F.col("person_rows")))
    require_none(wrong, "A staged crash does not have exactly its staged rows and hash.")
    mixed = fact.groupBy("instanceid").agg(F.count_distinct("crash_hash").alias("n"), F.count_if(F.col("crash_hash").isNull()).alias("blank")).where("n <> 1 OR blank > 0")
    require_none(mixed, "A fact crash has no hash or more than one.")


def unique_keys(dims: dict[str, DataFrame]) -> None:
    for name, d in dims.items():
        for column in [c for c in d.columns if c.endswith("_key") or c.endswith("_nk")]:
            require_none(repeated(d, column), f"{name} repeats a {column}.")
