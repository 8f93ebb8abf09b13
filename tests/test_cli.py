import datetime as dt
import json

import pytest

from starpanel.plans import cli
from starpanel.plans.panel import PanelConfig
from starpanel.sources.store import Warehouse


@pytest.mark.parametrize("argv", ["", "--delta --full --feed x", "--delta", "--reprocess --delta --feed x", "--allow-deletions --panel", "--reprocess"])
def test_flags_are_refused(argv):
    with pytest.raises(SystemExit):
        cli.arguments(["--root", "w", *argv.split()])


def test_flags():
    a = cli.arguments("--root w --full --feed x --reprocess --panel".split())
    assert a.setup and a.panel and not a.delta


def test_full_load_and_panel(spark, tmp_path):
    start, feed = dt.date(2024, 1, 1), tmp_path / "feed.json"
    with open(feed, "w") as f:
        for i in range(240):
            day = start + dt.timedelta(days=(i * 7) % 120)
            f.write(json.dumps({":id": f"p{i}", ":version": "1", ":updated_at": "2026-10-15T00:00:00.000Z", "reportnumber": f"R{i}", "eventdate": f"{day}T10:00:00", "snaneighborhood": "Clifton", "latitude": "39.1", "longitude": "-84.5", "typeofperson": "D - Driver"}) + "\n")
    config = PanelConfig(start=start, min_events=5)
    got = cli.run(spark, ["--root", str(tmp_path / "w"), "--feed", str(feed), "--setup", "--full", "--panel"], config, dt.date(2024, 12, 31))
    w = Warehouse(spark, str(tmp_path / "w"))
    assert got.crashes_new == 240 and w.read("etl_load_log").first().status == "succeeded"
    assert w.read("ml_crash_panel").count() == (dt.date(2024, 4, 29) - dt.timedelta(days=7) - start).days + 1
    assert w.labels("ml_crash_panel") == {"scheme": "neighborhood", "built_by": "full"}
