"""Loads end to end on a small warehouse."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starpanel.operators import fact as X
from starpanel.operators.checks import LoadAborted
from starpanel.operators.lease import Lease, LeaseHeld
from starpanel.plans.load import mark, run_load, setup, watermark
from starpanel.schema import STAGING, TABLES, conform
from starpanel.sources.extract import Manifest
from starpanel.sources.store import Warehouse

STAMP, START = "2026-10-15 00:00:00", dt.datetime(2026, 10, 20)


def person(i, report, **more):
    row = dict.fromkeys(STAGING.fieldNames()) | {
        "socrata_id": i, "socrata_version": "1", "socrata_updated_at": STAMP, "reportnumber": report, "eventdate": "2026-01-02T03:04:05.000", "reportdate": "2026-01-02T04:04:05.000",
        "address": "1610 Joseph St", "latitude": "39.1", "longitude": "-84.5", "snaneighborhood": "Clifton", "lightconditionsprimary": "1 - Daylight", "roadconditionsprimary": "1 - Dry", "crashseverity": "Fatal",
        "typeofperson": "D - Driver", "gender": "M - Male", "agerange": "20-24", "injuries": "1 - FATAL",
    }
    return row | more


ROWS = [person("a", "R1"), person("b", "R1", typeofperson="O - Occupant"), person("c", "R2"), person("d", "R3", eventdate="2025-06-01T00:00:00")]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("w") / "base"))
    setup(w)
    old = conform(spark.createDataFrame([("H1", "H1", "frozen", "h")], "instanceid string, localreportno string, source_dataset string, crash_hash string"), "fact_crash_person")
    w.commit({"fact_crash_person": old})
    load(w, ROWS + [person("h", "H1", snaneighborhood="Avondale")], "first")
    return w


@pytest.fixture
def w(base, tmp_path):
    return base.clone(str(tmp_path / "w"))


def load(w, rows, load_id, window=None, holder=None, **more):
    staged = w.spark.createDataFrame([tuple(r[c] for c in STAGING.fieldNames()) for r in rows], STAGING)
    m = Manifest(len(rows), STAMP, None)
    lease = Lease(w.root, load_id)
    if holder is None:
        lease.acquire()
    try:
        w.replace_staging(staged, m)
        return run_load(w, lease, m, load_id, "full" if window is None else "delta", window, START, **more)
    finally:
        lease.release()


def test_first_load(base):
    f = base.read("fact_crash_person")
    own = {r.socrata_id: r for r in f.where("source_dataset = 'owned'").collect()}
    assert set(own) == set("abcd")
    assert own["a"].is_fatal == 1 and own["a"].reporting_lag_hours == 1.0 and own["a"].crash_time_key == 304 and own["a"].crash_date_key == 20260102
    assert f.where("source_dataset = 'frozen'").first().neighborhood == "Avondale"
    assert base.read("dim_location").where("location_key > 0").first().address == "16XX JOSEPH ST"
    log = base.read("etl_load_log").first()
    assert (log.crashes_new, log.fact_inserted, log.status) == (3, 4, "fact_committed")


def test_rerun_and_refuzz_change_nothing(w):
    moved = [r | {"latitude": "39.1009", "longitude": "-84.5007"} for r in ROWS]
    for i, rows in enumerate((ROWS, ROWS + [ROWS[0]], moved)):
        got = load(w, rows, f"again{i}")
        assert (got.crashes_new, got.crashes_changed, got.crashes_removed, got.crashes_deferred) == (0, 0, 0, 0)


def test_change_removal_and_deferral(w):
    rows = [ROWS[0], ROWS[1] | {"injuries": "2 - Possible Injury"}, ROWS[3] | {"weather": "Rain"}, person("e", "R4")]
    got = load(w, rows, "delta", dt.date(2026, 1, 1))
    assert (got.crashes_new, got.crashes_changed, got.crashes_removed, got.crashes_deferred) == (1, 1, 1, 1)
    kept = {r.socrata_id for r in w.read("fact_crash_person").where("source_dataset = 'owned'").collect()}
    assert kept == {"a", "b", "d", "e"}


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([], "Staging is empty"), (ROWS[:1], "Refusing|but the fact has"), (ROWS + [ROWS[0] | {"gender": "F - Female"}], "two contents"), (ROWS + [person("z", "R9", weather="a|b")], "natural-key"),
        (ROWS + [person("z", "R9", socrata_updated_at=None)], "stamp"), (ROWS + [person("z", "R9", socrata_updated_at="2026-10-16 00:00:00")], "more than one publish"),
    ],
)
def test_rejected_staging(w, rows, message):
    before = w.manifest()["tables"]["fact_crash_person"]
    with pytest.raises(LoadAborted, match=message):
        load(w, rows, "bad")
    assert w.manifest()["tables"]["fact_crash_person"] == before


def test_rollback_and_fence(w):
    before = w.manifest()

    def boom(new):
        raise LoadAborted("forced")

    with pytest.raises(LoadAborted, match="forced"):
        load(w, ROWS + [person("e", "R4")], "x", extra_check=boom)
    with pytest.raises(LeaseHeld):
        load(w, ROWS + [person("e", "R4")], "y", holder="nobody")
    after = w.manifest()
    assert all(before["tables"][t] == after["tables"][t] for t in ("fact_crash_person", "etl_load_log"))


def test_cap_on_deletions():
    X.check_cap(100, 10, False)
    X.check_cap(101, 10, True)
    X.check_cap(150, 20_000, False)
    with pytest.raises(LoadAborted, match="would delete 101"):
        X.check_cap(101, 10, False)


def test_reprocess_keeps_keys(w):
    key = w.read("dim_location").where("location_key > 0").select("location_key", "location_nk").collect()
    got = load(w, ROWS, "re", reprocess=True)
    assert got.crashes_changed == 3 and w.read("dim_location").where("location_key > 0").select("location_key", "location_nk").collect() == key


def test_log_marks(w):
    mark(w, "first", "succeeded")
    mark(w, "first", "failed", "late")
    mark(w, "unknown", "failed", "line one\nline two")
    got = {r.load_id: r for r in w.read("etl_load_log").collect()}
    assert got["first"].status == "succeeded" and got["first"].error_message is None
    assert got["unknown"].error_message == "line one"


def test_watermark(spark):
    f = lambda rows: conform(spark.createDataFrame(rows, "crash_date date, source_dataset string, neighborhood string"), "fact_crash_person")
    assert watermark(f([(dt.date(2026, 4, 1), "owned", None), (dt.date(2030, 1, 1), "owned", None)]), dt.date(2026, 5, 1)) == (dt.date(2026, 1, 1), False)
    assert watermark(f([(dt.date(2026, 4, 1), "owned", None), (dt.date(2020, 1, 1), "frozen", None)]), dt.date(2026, 5, 1)) == (None, True)
    assert watermark(f([]), dt.date(2026, 5, 1)) == (None, False)


def test_post_image_checks(base):
    f = base.read("fact_crash_person")
    k = X.classify(base.spark.createDataFrame([], "instanceid string, row_json string"), f.where("source_dataset = 'owned'"), None)
    X.post_image_checks(f, f, k)
    with pytest.raises(LoadAborted, match="frozen"):
        X.post_image_checks(f.where("source_dataset = 'owned'"), f, k)
    with pytest.raises(LoadAborted, match="no hash"):
        X.post_image_checks(f.withColumn("crash_hash", F.when(F.col("socrata_id") != "a", F.col("crash_hash"))), f, k)


def test_every_fact_column_is_filled(base):
    assert base.read("fact_crash_person").columns == TABLES["fact_crash_person"].columns


def test_untouched_months_keep_their_files(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    setup(w)
    load(w, ROWS, "first")
    before, stored = w.manifest()["tables"]["fact_crash_person"], sorted(map(repr, w.read("fact_crash_person").drop("loaded_at").collect()))
    assert len(before) == 2 and len(set(before.values())) == 1
    load(w, [r | {"weather": "Rain"} if r["socrata_id"] == "d" else r for r in ROWS], "second")
    after = w.manifest()["tables"]["fact_crash_person"]
    assert sorted(before) == sorted(after) and [m for m in before if before[m] != after[m]] == ["crash_month=2025-06-01"]
    now = sorted(map(repr, w.read("fact_crash_person").drop("loaded_at").collect()))
    assert len(now) == len(stored) and len(set(now) ^ set(stored)) == 2
    load(w, [r | {"weather": "Rain"} if r["socrata_id"] == "d" else r for r in ROWS], "third")
    assert w.manifest()["tables"]["fact_crash_person"] == after
