"""The panel's proofs, and that broken panels fail them."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starpanel.operators.checks import LoadAborted
from starpanel.operators.holidays import holidays
from starpanel.plans import monitor
from starpanel.plans import panel as P
from starpanel.schema import conform, empty

START, END = dt.date(2024, 1, 1), dt.date(2025, 3, 31)
CONFIG = P.PanelConfig(start=START, min_events=20, valid_start=dt.date(2024, 7, 1), test_start=dt.date(2025, 1, 1))


@pytest.fixture(scope="module")
def built(spark):
    n = (END - START).days + 1
    rows = [(f"e{i}", START + dt.timedelta(days=(i * i * 7 + i) % n), "AB"[i % 2]) for i in range(600)] + [("z", START, "C"), ("y", START, None)]
    events = spark.createDataFrame(rows, "event string, day date, cell_id string")
    points = spark.createDataFrame([("A", -84.5, 39.1), ("B", -84.4, 39.2)], "cell_id string, longitude double, latitude double")
    p, cells = P.build(events, points, CONFIG, END, empty(spark, "ml_weather_daily"), empty(spark, "ml_cell_attributes"))
    return p.persist(), cells.persist()


def test_panel_passes(built):
    P.check_panel(*built, CONFIG, END)
    p, cells = built
    assert {r.cell_id for r in cells.collect()} == {"A", "B"}
    assert {r.split for r in p.select("split").distinct().collect()} == {"train", "valid", "test"}


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda p: p.withColumn("roll_28", F.avg("crashes").over(Window.partitionBy("cell_id").orderBy("day").rowsBetween(-27, 0))), "Leakage"),
        (lambda p: p.withColumn("crashes_next_7", F.when(F.col("crashes_next_7").isNotNull(), F.col("crashes_next_7") + 1)), "label"),
        (lambda p: p.where("day > '2024-01-01'"), "not those|cells x days"),
        (lambda p: p.withColumn("exposure_source", F.when(F.col("cell_id") == "A", "x").otherwise("y")), "mix"),
        (lambda p: p.withColumn("exposure", F.lit(0.0)), "positive"),
        (lambda p: p.withColumn("distance_to_cbd_km", F.lit(None).cast("double")), "coordinates"),
    ],
)
def test_broken_panels_fail(built, change, message):
    with pytest.raises(LoadAborted, match=message):
        P.check_panel(change(built[0]), built[1], CONFIG, END)


def test_inputs(spark):
    day = conform(spark.createDataFrame([(START,), (START,)], "day date"), "ml_weather_daily")
    with pytest.raises(LoadAborted):
        P.check_inputs(day, empty(spark, "ml_cell_attributes"))


def test_holidays(spark):
    got = {r.day.isoformat() for r in holidays(spark, 2019, 2025).collect()}
    assert {"2021-07-04", "2021-07-05", "2020-07-03", "2020-07-04", "2021-06-18", "2021-06-19", "2024-11-28", "2024-05-27"} <= got
    assert not {"2020-06-19", "2020-06-18"} & got


def test_crash_cells(spark):
    f = conform(spark.createDataFrame([("x", START, "n/a", 1), ("x", END, "clifton", 1), ("y", START, None, 2)], "instanceid string, crash_date date, neighborhood string, location_key int"), "fact_crash_person")
    d = conform(spark.createDataFrame([(1, "Avondale"), (2, None)], "location_key int, cpd_neighborhood string"), "dim_location")
    cells = lambda scheme: {r.event: (r.day, r.cell_id) for r in P.crash_cells(f, d, P.PanelConfig(scheme=scheme, start=START), END).collect()}
    assert cells("neighborhood") == {"x": (END, "CLIFTON"), "y": (START, None)}
    assert cells("cpd_neighborhood") == {"x": (END, "AVONDALE"), "y": (START, None)}
    with pytest.raises(LoadAborted):
        P.crash_cells(f, d, P.PanelConfig(scheme="zip"), END)


def test_forecast_metrics(built):
    p = built[0].withColumn("expected", F.lit(4.0))
    assert P.poisson_deviance(p, "crashes_next_7", "expected").first().deviance > 0
    assert P.predictive_accuracy_index(built[0], "crashes_next_7", "roll_28").first().pai > 0


def test_monitor(spark):
    with pytest.raises(monitor.Unhealthy):
        monitor.check(spark.createDataFrame([("x",)], "problem string"))
    assert monitor.check(spark.createDataFrame([], "problem string")) == "ok"
