"""A load from staging to the committed fact."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpanel.operators import checks, dims, fact
from starpanel.operators.clean import FROZEN, KEYED, OWNED, clean
from starpanel.operators.lease import Lease
from starpanel.schema import TABLES, conform
from starpanel.sources.store import Warehouse

LOOKBACK_DAYS = 90
MERGED = ("dim_location", "dim_conditions", "dim_crash_type", "dim_person_profile")


def setup(w: Warehouse) -> None:
    """Creates the calendars, unknown members and empty tables that aren't there."""
    spark, new = w.spark, {}
    for name in TABLES:
        if not w.exists(name):
            df = dims.calendar(spark) if name == "dim_date" else dims.times_of_day(spark) if name == "dim_time" else w.read(name)
            new[name] = dims.with_unknown(df, name) if name in dims.UNKNOWN_MEMBERS else df
    if new:
        w.commit(new)


def watermark(f: DataFrame, today: dt.date, lookback: int = LOOKBACK_DAYS) -> tuple[dt.date | None, bool]:
    """Where a delta starts (None: everything), and whether history without names asks for a full load."""
    got = f.agg(F.max(F.when((F.col("source_dataset") == OWNED) & (F.col("crash_date") <= F.lit(today)), F.col("crash_date"))).alias("newest"),
                F.count_if(F.col("source_dataset") == FROZEN).alias("old"), F.count_if((F.col("source_dataset") == FROZEN) & F.col("neighborhood").isNotNull()).alias("named")).first()
    unnamed = got.old > 0 and got.named == 0
    return (None if got.newest is None or unnamed else got.newest - dt.timedelta(days=lookback)), unnamed


@dataclass(frozen=True)
class Counts:
    crashes_new: int
    crashes_changed: int
    crashes_removed: int
    crashes_deferred: int
    rows_inserted: int
    rows_deleted: int
    crashes_in_history: int
    history_rows_named: int


def run_load(w: Warehouse, lease: Lease, manifest, load_id: str, mode: str, window_start: dt.date | None, started_at: dt.datetime, reprocess: bool = False, allow_deletions: bool = False, extra_check=None) -> Counts:
    """Validates staging, merges dimensions, classifies crashes and commits fact and audit row together."""
    c, staging, old = F.col, w.read("stg_crash_person"), w.read("fact_crash_person")
    checks.staging_checks(staging, old, manifest, KEYED)
    rows = clean(staging, old.where(c("source_dataset") == FROZEN).select("localreportno")).persist()
    people = None
    try:
        checks.completeness_check(rows, old.where(c("source_dataset") == OWNED), window_start)
        fresh = {n: dims.merge(w.read(n), df, n, nk, reprocess) for n, (nk, df) in dims.members(rows).items()}
        w.commit(fresh, lambda new: fact.unique_keys(new))  # new members do no harm if the fact fails later
        tables = {n: w.read(n) for n in ("dim_date", "dim_time", *MERGED)}
        people = fact.snapshot(rows).persist()
        k = fact.classify(people, old.where(c("source_dataset") == OWNED), window_start, reprocess)
        diff = k.differing.agg(F.count_if(~c("deferred") & c("is_new")).alias("new"), F.count_if(~c("deferred") & ~c("is_new")).alias("changed"), F.count_if("deferred").alias("deferred")).first()
        n_removed = k.removed.count()
        fact.check_cap(n_removed, k.state.where("in_window AND NOT before_window").count(), allow_deletions)
        new_rows = fact.fact_rows(people, k.changed, tables)
        names = fact.history_names(staging, old)
        post = fact.fill_history(fact.replaced(old, k.changed, k.removed, new_rows), names)
        log = w.read("etl_load_log")
        checks.require_none(log.where(c("load_id") == load_id), "This load id already has an audit record.")
        inserted = people.join(k.changed, "instanceid", "left_semi").count()
        kept = old.count()
        now, day = F.current_timestamp(), F.lit(window_start).cast("date")
        deleted = kept + inserted - post.count()
        stamp = rows.agg(F.date_format(F.max("socrata_updated_at"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()[0]
        entry = conform(w.spark.range(1).select(
            F.lit(load_id).alias("load_id"), F.lit(mode).alias("load_mode"), day.alias("window_start"), F.lit(started_at).alias("started_at"), now.alias("finished_at"), F.lit(manifest.expected_rows).alias("rows_staged"),
            F.lit(inserted).alias("fact_inserted"), F.lit(deleted).alias("fact_deleted"), F.lit(stamp).alias("socrata_updated_at"), F.lit(diff.new).alias("crashes_new"), F.lit(diff.changed).alias("crashes_changed"),
            F.lit(n_removed).alias("crashes_removed"), F.lit(diff.deferred).alias("crashes_deferred"), F.lit("fact_committed").alias("status"), now.alias("fact_committed_at"),
        ), "etl_load_log")
        named = old.where((c("source_dataset") == FROZEN) & c("neighborhood").isNull()).join(names.where(c("neighborhood").isNotNull()), "localreportno", "left_semi").count()

        def check(new: dict[str, DataFrame]) -> None:
            fact.post_image_checks(new["fact_crash_person"], old, k)
            if extra_check:
                extra_check(new)
            lease.renew("commit")  # the fence: whoever lost the lock publishes nothing

        months = fact.touched_months(old, k.changed, k.removed, new_rows, names)
        lease.submitting()
        try:
            w.commit({"fact_crash_person": post, "etl_load_log": log.unionByName(entry)}, check, months={"fact_crash_person": months})
        finally:
            lease.resolved()  # one manifest was replaced or it wasn't: either way the outcome is known
        return Counts(diff.new, diff.changed, n_removed, diff.deferred, inserted, deleted, names.count(), named)
    finally:
        for held in (rows, people):
            if held is not None:
                held.unpersist()


def mark(w: Warehouse, load_id: str, status: str, error: str | None = None) -> None:
    """Sets a load's status; a load that succeeded stays so; an unknown load gets a row if it failed."""
    log, c = w.read("etl_load_log"), F.col
    note = (error or "").split("\n")[0][:1000] or None
    if log.where(c("load_id") == load_id).isEmpty():
        if status != "failed":
            return
        row = conform(w.spark.range(1).select(F.lit(load_id).alias("load_id"), F.lit(status).alias("status"), F.lit(note).alias("error_message"), F.current_timestamp().alias("finished_at")), "etl_load_log")
        w.commit({"etl_load_log": log.unionByName(row)})
        return
    mine = (c("load_id") == load_id) & (c("status") != "succeeded")
    w.commit({"etl_load_log": log.withColumn("status", F.when(mine, status).otherwise(c("status"))).withColumn("error_message", F.when(mine, F.lit(note)).otherwise(c("error_message")))})
