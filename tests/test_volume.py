"""What queries move between tasks, as Spark itself counts it."""

import datetime as dt

import pytest

from starpanel.plans import library, reports  # noqa: F401
from starpanel.plans.catalogue import QUERIES
from starpanel.schema import conform
from starpanel.sources.store import SORTED_MB, Warehouse, _tasks_of_at_most


def moved(spark, job):
    """(bytes, rows) that the stages of a job wrote for a shuffle."""
    sc = spark.sparkContext._jsc.sc()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway

    def stages():
        sc.listenerBus().waitUntilEmpty()
        found = sc.statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): (s.shuffleWriteBytes(), s.shuffleWriteRecords()) for s in (found.apply(i) for i in range(found.size()))}

    before = stages()
    job()
    new = [v for k, v in stages().items() if k not in before]
    assert new
    return sum(b for b, _ in new), sum(r for _, r in new)


def test_second_load_moves_content_once(spark, data):
    """No table is broadcast, as large ones aren't."""
    lines = spark.read.parquet(f"{data}/lineitem.parquet").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        size, _ = moved(spark, lambda: QUERIES["second_load"](spark, data).write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert size < 160 * lines


def test_grain_takes_no_row_for_each_date(spark):
    """A crash of 20,000 dates, one of one date and one of none, whose rows meet as one row of each task."""
    f = spark.sql("""SELECT 'owned' AS source_dataset, CASE WHEN id < 20000 THEN 'many' WHEN id < 20010 THEN 'one' ELSE 'none' END AS instanceid,
     CASE WHEN id < 20000 THEN date_add(DATE '1970-01-01', CAST(id AS INT)) WHEN id < 20009 THEN DATE '1970-01-01' END AS crash_date, 'x' AS socrata_id, CAST(NULL AS STRING) AS neighborhood FROM range(20020)""")
    got = []
    _, rows = moved(spark, lambda: got.extend(reports.grain(f).collect()))
    assert rows < 200
    assert [tuple(r) for r in got] == [("owned", 20020, 3, 6673.333, 1, 20019, 3, dt.date(1970, 1, 1) + dt.timedelta(days=19999))]


def test_lacking_columns_are_nulls(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    rows = spark.createDataFrame([("a", dt.date(2026, 1, 2), 3), ("b", None, 4)], "instanceid string, crash_date date, person_count long")
    w.commit({"fact_crash_person": rows})
    assert sorted(map(repr, w.read("fact_crash_person").collect())) == sorted(map(repr, conform(rows, "fact_crash_person").collect()))


@pytest.mark.parametrize(("asked", "inside"), [(None, f"{SORTED_MB}m"), ("64MB", f"{SORTED_MB}m"), ("8m", "8m"), ("1g", f"{SORTED_MB}m"), ("4096", "4096")])
def test_size_of_writing_tasks(spark, asked, inside):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        if asked:
            spark.conf.set(key, asked)
        before = spark.conf.get(key)
        with pytest.raises(KeyError), _tasks_of_at_most(spark, SORTED_MB):
            assert spark.conf.get(key) == inside
            raise KeyError
        assert spark.conf.get(key) == before and (asked or spark.conf.get(key, None) is None)
    finally:
        spark.conf.unset(key)
