"""Guards: each gives a row for a problem and none when all is well."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


class Unhealthy(RuntimeError):
    pass


def problems(lease: DataFrame, log: DataFrame, days: DataFrame, now: dt.datetime) -> DataFrame:
    """(problem): from the lock (holder, heartbeat_at), the run log and the fact's crash dates. No log at all counts."""
    at = lambda **age: F.lit(now - dt.timedelta(**age))
    say = lambda text: F.lit(text).alias("problem")
    held = lease.where(c("holder").isNotNull() & (c("heartbeat_at") < at(hours=2))).select(say("lock held for over 2 hours"))
    good = log.where("status = 'succeeded'")
    silent = good.agg(F.max("finished_at").alias("m")).where(c("m").isNull() | (c("m") < at(hours=24))).select(say("no load succeeded in 24 hours"))
    stamp = F.try_to_timestamp(F.regexp_replace("s", "Z$", "")).cast("timestamp_ntz")
    stale = good.agg(F.max_by("socrata_updated_at", "finished_at").alias("s")).where(stamp.isNull() | (stamp < at(days=21))).select(say("publish stamp is over 21 days old"))
    old = days.agg(F.max("crash_date").alias("m")).where(c("m").isNull() | (c("m") < F.lit((now - dt.timedelta(days=60)).date()))).select(say("newest crash is over 60 days old"))
    return held.unionByName(silent).unionByName(stale).unionByName(old)


def check(found: DataFrame) -> str:
    rows = [r.problem for r in found.collect()]
    if rows:
        raise Unhealthy("; ".join(rows))
    return "ok"
