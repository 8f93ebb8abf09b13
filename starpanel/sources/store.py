"""Versioned Parquet tables behind one manifest.

A commit writes every touched table to a folder of its own and then replaces the manifest in one step, so readers see
all tables of a commit or none; a failure before that leaves the old manifest. Of a table by months the manifest names
the folder of each month, and a commit may write some months only: the others keep their files. Valid on one POSIX
file system.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.functions.semantics import row_json
from starpanel.operators.checks import LoadAborted, require
from starpanel.schema import TABLES, empty

_NAME = re.compile(r"[a-z][a-z0-9_]{0,62}")
_LABEL_KEY, _LABEL_VALUE = re.compile(r"[a-z][a-z0-9_-]{0,62}"), re.compile(r"[a-z0-9_-]{0,63}")
#: Shuffled MB that one task sorts and writes: rows with many nulls take over twenty times as much once they are read.
SORTED_MB = 32


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: the exclusive or of the first 60 bits of every row's hash, whatever the order of rows."""
    return df.agg(F.bit_xor(F.conv(F.left(F.md5(row_json(*df.columns)), F.lit(15)), 16, 10).cast("long")).alias("fingerprint"))


def _month_folder(month: dt.date | None) -> str:
    return f"crash_month={month.isoformat() if month else '__HIVE_DEFAULT_PARTITION__'}"


def scratch(spark: SparkSession) -> str:
    """A new folder for a warehouse of one query, under the folder that the cluster shares."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        where = tempfile.mkdtemp(prefix="starpanel-")
    if "://" in where and not where.startswith("file://"):
        raise RuntimeError("a warehouse needs a POSIX file system")
    return os.path.join(where.removeprefix("file://"), f"warehouse-{uuid.uuid4().hex}")


@contextlib.contextmanager
def _tasks_of_at_most(spark: SparkSession, mb: int):
    """What is written meanwhile is dealt out in parts of so many shuffled MB, or smaller ones if the session asks for them."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, own = spark.conf.get(key), spark.conf.get(key, None)
    size = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", before.strip().lower())
    if size and int(size[1]) * 1024 ** "bkmgtp".find(size[2] or "b") <= mb * 2**20:
        yield
        return
    spark.conf.set(key, f"{mb}m")
    try:
        yield
    finally:
        spark.conf.set(key, own) if own is not None else spark.conf.unset(key)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, os.path.abspath(root)
        os.makedirs(self.root, exist_ok=True)

    @property
    def _path(self) -> str:
        return os.path.join(self.root, "manifest.json")

    def manifest(self) -> dict:
        if not os.path.exists(self._path):
            return {"version": 0, "tables": {}, "labels": {}}
        with open(self._path) as f:
            return json.load(f)

    def _publish(self, manifest: dict, version: int) -> None:
        if self.manifest()["version"] != version:
            raise LoadAborted("Another commit was published meanwhile.")
        part = f"{self._path}.{uuid.uuid4().hex}"
        with open(part, "w") as f:
            json.dump(manifest | {"version": version + 1}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, self._path)

    def exists(self, name: str) -> bool:
        return name in self.manifest()["tables"]

    def read(self, name: str) -> DataFrame:
        where = self.manifest()["tables"].get(name)
        if where is None:
            if name in TABLES:
                return empty(self.spark, name)
            raise KeyError(name)
        return self._open(name, where)

    def _open(self, name: str, where: str | dict[str, str]) -> DataFrame:
        """A registered table is read by its schema: a version without rows may have no files, and one that is
        partitioned has the column it is partitioned by besides."""
        if isinstance(where, dict):
            if not where:
                return empty(self.spark, name)
            return self.spark.read.schema(TABLES[name].schema).parquet(*(os.path.join(self.root, w, month) for month, w in sorted(where.items()))).select(*TABLES[name].schema.names)
        path = os.path.join(self.root, where)
        if name not in TABLES:
            return self.spark.read.parquet(path)
        return self.spark.read.schema(TABLES[name].schema).parquet(path).select(*TABLES[name].schema.names)

    def write(self, df: DataFrame, name: str) -> str:
        """Writes a version of a table, clustered and partitioned as registered; it isn't visible yet. Columns that the
        frame lacks are read as nulls."""
        if not _NAME.fullmatch(name):
            raise ValueError(f"bad table name {name!r}")
        where = f"{name}/{uuid.uuid4().hex}"
        spec = TABLES.get(name)
        cluster = [k for k in spec.cluster if k in df.columns] if spec else []
        if spec and spec.partition == ("crash_month",):
            writer = df.withColumn("crash_month", F.trunc("crash_date", "MM")).hint("rebalance", "crash_month").sortWithinPartitions("crash_month", *cluster).write.partitionBy("crash_month")
        else:
            writer = (df.sortWithinPartitions(*cluster) if cluster else df).write
        with _tasks_of_at_most(self.spark, SORTED_MB):
            writer.parquet(os.path.join(self.root, where))
        return where

    def commit(
        self, tables: dict[str, DataFrame], check: Callable[[dict[str, DataFrame]], None] | None = None, labels: dict[str, dict[str, str]] | None = None, months: dict[str, set[dt.date | None]] | None = None
    ) -> None:
        """Writes the tables, hands what was written to ``check``, and publishes all of them in one step.

        ``months``: for tables by months, those that are replaced; rows of others stay as they are stored, and the
        frame need not hold them. A failure of the check leaves nothing behind.
        """
        before = self.manifest()
        for per in (labels or {}).values():
            for k, v in per.items():
                if not _LABEL_KEY.fullmatch(k) or not _LABEL_VALUE.fullmatch(v):
                    raise ValueError(f"bad label {k}={v}")
        written, now = {}, {}
        try:
            for name, df in tables.items():
                replaced = None if months is None else months.get(name)
                if replaced is not None:
                    month = F.trunc("crash_date", "MM")
                    df = df.where(month.isin([m for m in replaced if m]) | (month.isNull() & F.lit(None in replaced)))
                written[name] = now[name] = self.write(df, name)
                if name in TABLES and TABLES[name].partition:
                    kept = before["tables"].get(name, {}) if replaced is not None else {}
                    gone = {_month_folder(m) for m in replaced or ()}
                    new = {x: written[name] for x in os.listdir(os.path.join(self.root, written[name])) if x.startswith("crash_month=")}
                    now[name] = {m: w for m, w in kept.items() if m not in gone} | new
            if check:
                check({n: self._open(n, w) for n, w in now.items()})
            after = before | {"tables": before["tables"] | now, "labels": {**before["labels"], **{n: before["labels"].get(n, {}) | x for n, x in (labels or {}).items()}}}
            self._publish(after, before["version"])
        except BaseException:
            for w in written.values():
                shutil.rmtree(os.path.join(self.root, w), ignore_errors=True)
            raise

    def labels(self, name: str) -> dict[str, str]:
        return self.manifest()["labels"].get(name, {})

    def replace_staging(self, staged: DataFrame, manifest) -> int:
        """Replaces staging by a verified extract; what was written is counted again."""
        require(manifest is not None, "An extract without a manifest is not loaded.")

        def check(new: dict[str, DataFrame]) -> None:
            require(new["stg_crash_person"].count() == manifest.expected_rows, "Staging does not hold the extract's rows.")

        self.commit({"stg_crash_person": staged}, check)
        return manifest.expected_rows

    def clone(self, root: str) -> Warehouse:
        shutil.copytree(self.root, root)
        return Warehouse(self.spark, root)

    def fingerprint(self, name: str) -> int:
        """An order-insensitive hash of a table's rows."""
        return self.read(name).transform(fingerprint).first()[0]
