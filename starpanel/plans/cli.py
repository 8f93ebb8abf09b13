"""Command line: setup, loads and the panel on a warehouse folder.

    python -m starpanel.plans.cli --root DIR --feed PAGES.json --full --panel
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import re
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starpanel.operators.lease import Lease, raise_on_sigterm
from starpanel.plans import monitor, reports
from starpanel.plans.load import Counts, mark, run_load, setup, watermark
from starpanel.plans.panel import PanelConfig, build, check_inputs, check_panel, crash_cells, panel_end
from starpanel.sources.extract import FileFeed, fetch
from starpanel.sources.store import Warehouse


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="starpanel")
    p.add_argument("--root", required=True, help="warehouse folder")
    p.add_argument("--feed", help="JSON Lines of the feed's rows")
    p.add_argument("--setup", action="store_true", help="create what isn't there")
    mode = p.add_mutually_exclusive_group()
    mode.add_argument("--delta", action="store_true", help="load the window since the high-water mark")
    mode.add_argument("--full", action="store_true", help="load everything")
    p.add_argument("--reprocess", action="store_true", help="rewrite every owned crash (with --full)")
    p.add_argument("--allow-deletions", action="store_true", help="lift the cap on removed crashes (with a load)")
    p.add_argument("--panel", action="store_true", help="rebuild the panel")
    p.add_argument("--watchdog", action="store_true", help="run the guards")
    a = p.parse_args(argv)
    if a.reprocess and not a.full:
        p.error("--reprocess needs --full")
    if a.allow_deletions and not (a.delta or a.full):
        p.error("--allow-deletions needs a load")
    if (a.delta or a.full) and not a.feed:
        p.error("a load needs --feed")
    if not (a.setup or a.delta or a.full or a.panel or a.watchdog):
        p.error("nothing to do")
    if not re.fullmatch(r"[^\0`]+", a.root):
        p.error("bad warehouse folder")
    a.setup = a.setup or a.reprocess
    return a


def build_panel(w: Warehouse, config: PanelConfig = PanelConfig(), today: dt.date | None = None, label: str = "manual") -> None:
    """Builds the panel, proves it and publishes it with its labels; a failed proof publishes nothing."""
    fact, weather, attributes = w.read("fact_crash_person"), w.read("ml_weather_daily"), w.read("ml_cell_attributes")
    check_inputs(weather, attributes)
    end = panel_end(fact.select(F.col("crash_date").alias("day")), today or dt.date.today(), config.buffer_days)
    events = crash_cells(fact, w.read("dim_location"), config, end)
    points = events.select("event", "cell_id").join(fact.select(F.col("instanceid").alias("event"), "longitude", "latitude"), "event")
    p, cells = build(events, points, config, end, weather, attributes)
    p = p.repartition("split").sortWithinPartitions("split", "cell_id", "day")
    w.commit({"ml_crash_panel": p}, lambda new: check_panel(new["ml_crash_panel"], cells, config, end), {"ml_crash_panel": {"scheme": config.scheme, "built_by": label}})


def run(spark: SparkSession, argv: Sequence[str] | None = None, config: PanelConfig = PanelConfig(), today: dt.date | None = None) -> Counts | None:
    a, counts = arguments(argv), None
    w, load_id = Warehouse(spark, a.root), uuid.uuid4().hex
    if a.watchdog:
        held = spark.createDataFrame([], "holder string, heartbeat_at timestamp_ntz")
        log = w.read("etl_load_log").withColumn("finished_at", F.col("finished_at").cast("timestamp_ntz"))
        print(monitor.check(monitor.problems(held, log, w.read("fact_crash_person").select("crash_date"), dt.datetime.now())))
        return None
    raise_on_sigterm()
    lease, started = Lease(w.root, load_id), dt.datetime.now()
    lease.acquire()
    mode, window = ("delta" if a.delta else "full" if a.full else "panel"), None
    try:
        if a.setup:
            setup(w)
        if a.delta or a.full:
            if a.delta:
                window, _ = watermark(w.read("fact_crash_person"), today or dt.date.today())
            with open(a.feed) as f:
                feed = FileFeed(json.loads(line) for line in f)
            staged, manifest = fetch(spark, feed, os.path.join(w.root, "pages", load_id), None if window is None else window.isoformat())
            w.replace_staging(staged, manifest)
            counts = run_load(w, lease, manifest, load_id, mode if window or not a.delta else "full", window, started, a.reprocess, a.allow_deletions)
            reports.show("Grain", reports.grain(w.read("fact_crash_person")))
            reports.show("Source quality", reports.source_quality(w.read("fact_crash_person")))
        if a.panel:
            build_panel(w, replace(config), today, label=mode)
            reports.show("Panel", reports.panel_summary(w.read("ml_crash_panel")))
        if counts:
            mark(w, load_id, "succeeded")
        return counts
    except BaseException as error:
        if not lease.unknown:  # else nobody knows what came of the last write: the record would guess
            mark(w, load_id, "failed", str(error))
        raise
    finally:
        lease.release()


if __name__ == "__main__":
    run(SparkSession.builder.appName("starpanel").config("spark.sql.session.timeZone", "UTC").getOrCreate())
