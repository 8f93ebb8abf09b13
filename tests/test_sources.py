"""The extract, the store, the lock and the registry."""

import threading

import pytest
from pyspark.sql import functions as F

from starpanel.operators.checks import LoadAborted, require
from starpanel.operators.lease import Lease, LeaseHeld
from starpanel.schema import STAGING_COLUMNS, TABLES, conform, mermaid
from starpanel.sources import extract as E
from starpanel.sources.store import Warehouse

STAMP = "2026-10-15T00:00:00.000Z"


def person(i, **more):
    return {":id": i, ":version": "1", ":updated_at": STAMP, "reportnumber": f"R{i}", "eventdate": "2026-01-02T03:04:05.000"} | more


def test_pages_are_complete(spark, tmp_path):
    df, m = E.fetch(spark, E.FileFeed([person("a", agerange="BB"), person("b", reportnumber="Ra")]), str(tmp_path), page_size=1)
    assert df.columns == list(STAGING_COLUMNS) and {t for _, t in df.dtypes} == {"string"}
    assert m.expected_rows == 2 and m.publish_stamp == STAMP
    got = {r.socrata_id: r for r in df.collect()}
    assert got["a"].agerange == "BB" and got["b"].agerange is None and got["b"].reportnumber == "Ra"


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([], "empty"), ([person("a"), person("a")], "Repeated"), ([person(None)], "socrata_id"), ([person("a", reportnumber=" ")], "reportnumber"),
        ([person("a") | {":updated_at": None}], "stamp"), ([person("a"), person("b") | {":updated_at": "2026-10-16"}], "more than one publish"),
    ],
)
def test_bad_snapshots(spark, tmp_path, rows, message):
    with pytest.raises(E.InvalidSnapshot, match=message):
        E.fetch(spark, E.FileFeed(rows), str(tmp_path))


def test_missing_page_and_republish(spark, tmp_path):
    feed = E.FileFeed([person("a"), person("b")])
    feed.page = lambda since, offset, limit: [person("a")]
    with pytest.raises(E.InvalidSnapshot, match="Expected 2"):
        E.fetch(spark, feed, str(tmp_path / "x"))
    feed, stamps = E.FileFeed([person("a")]), iter(range(99))
    feed.metadata = lambda: {"columns": list(E.SOURCE_COLUMNS), "rows_updated_at": next(stamps)}
    with pytest.raises(E.InvalidSnapshot, match="changed during extraction"):
        E.fetch(spark, feed, str(tmp_path / "y"))


def test_arguments(spark, tmp_path):
    feed = E.FileFeed([person("a")])
    for size in (0, -1, True, "100", 1.5):
        with pytest.raises(ValueError):
            E.fetch(spark, feed, str(tmp_path), page_size=size)
    with pytest.raises(ValueError):
        E.fetch(spark, feed, str(tmp_path), since="2026-01-01' OR true")
    assert feed.calls == 0
    assert E.check_columns({"columns": [*E.SOURCE_COLUMNS, "new"], "rows_updated_at": 1}) == ["new"]
    with pytest.raises(E.InvalidSnapshot):
        E.check_columns({"columns": ["weather"], "rows_updated_at": 1})


def test_retries():
    answers = iter([(429, None), (503, None), (200, "ok")])
    assert E.RetryingSession(lambda *_: next(answers), wait=lambda _: None)("u", {}) == "ok"
    with pytest.raises(E.InvalidSnapshot):
        E.RetryingSession(lambda *_: (500, None), attempts=2, wait=lambda _: None)("u", {})
    with pytest.raises(E.InvalidSnapshot):
        E.RetryingSession(lambda *_: (404, None))("u", {})


def test_store(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    one, two = spark.range(3).toDF("n"), spark.range(5).toDF("n")
    w.commit({"numbers": one, "others": two}, labels={"numbers": {"built_by": "test"}})
    assert w.read("numbers").count() == 3 and w.labels("numbers") == {"built_by": "test"}

    def refuse(new):
        assert new["numbers"].count() == 5
        raise LoadAborted("no")

    print_before = w.fingerprint("numbers")
    with pytest.raises(LoadAborted):
        w.commit({"numbers": two, "others": one}, refuse)
    assert w.fingerprint("numbers") == print_before and w.read("others").count() == 5
    c = w.clone(str(tmp_path / "c"))
    c.commit({"numbers": two})
    assert w.read("numbers").count() == 3 and c.read("numbers").count() == 5
    with pytest.raises(ValueError):
        w.commit({"Bad Name": one})
    with pytest.raises(ValueError):
        w.commit({"numbers": one}, labels={"numbers": {"Bad": "x"}})
    with pytest.raises(LoadAborted):
        w.replace_staging(one, None)


def test_lock_has_one_winner(tmp_path):
    won = []

    def go(k):
        try:
            Lease(str(tmp_path), f"h{k}").acquire()
            won.append(k)
        except LeaseHeld:
            pass

    threads = [threading.Thread(target=go, args=(k,)) for k in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert len(won) == 1
    mine, other = Lease(str(tmp_path), f"h{won[0]}"), Lease(str(tmp_path), "other")
    with pytest.raises(LeaseHeld):
        other.renew("x")
    assert not other.release()
    mine.renew("load")
    mine.submitting()
    assert not mine.release()  # nobody knows what came of the write: the lock stays
    mine.resolved()
    assert mine.release()
    other.acquire()


def test_registry(spark):
    text = mermaid()
    assert "dim_location ||--o{ fact_crash_person : location_key" in text and all(t in text for t in TABLES)
    old = spark.createDataFrame([("2020-01-01", 20)], "day string, age int")
    got = conform(old, "ml_weather_daily").first()
    assert str(got.day) == "2020-01-01" and got.tmax_f is None
    filled = conform(spark.createDataFrame([("x", 19, None)], "instanceid string, age int, age_range string"), "fact_crash_person", {"age_range": F.lit("16-19")}).first()
    assert filled.age_range == "16-19" and filled.crash_hash is None


def test_null_fails_an_assertion():
    for bad in (None, False, 0):
        with pytest.raises(LoadAborted):
            require(bad, "x")
