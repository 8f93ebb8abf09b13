"""What several operators of this subpackage share: tables, materialised tables, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text handed to a Python worker at once; bounds a batch's memory.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows and few bytes, for columns that hold whole texts.

    Spark reads these settings when a plan runs, so they stay; every operator that uses Arrow sets its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``); a session on one machine that has none gets a local one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        where = f"file://{tempfile.mkdtemp(prefix='starpanel-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_KEPT: dict = {}


def kept(make: Callable, *args):
    """``make(*args)``, kept by this Python worker for its next tasks; it holds one such object at a time."""
    if (make, args) not in _KEPT:
        _KEPT.clear()
        _KEPT[make, args] = make(*args)
    return _KEPT[make, args]


class Recent:
    """A table of results by key, of what was met last: two generations of at most ``size`` keys (or a batch's)."""

    def __init__(self, size: int):
        self.size, self.now, self.before = size, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that ``now`` has to be given results for; it has those of all others."""
        new = keys.difference(self.now)
        if len(self.now) + len(new) > self.size:
            self.before, self.now, new = self.now, {}, keys
        out, old = [], self.before
        for k in new:
            if k in old:
                self.now[k] = old[k]
            else:
                out.append(k)
        return out


#: Parquet checks its own pages; side files with checksums would double the files of a folder on a local or shared mount.
_PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


#: Narrow rows in a file of a table whose size is known, and files that a smaller table may have.
FILE_ROWS, FEW_FILES = 1_000_000, 8


class Written:
    """Tables written to the shared folder: they cut lineage and survive the loss of any executor.

    A result may read them as long as the driver lives; they are deleted when it ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/starpanel-{uuid.uuid4().hex}"
        path, files = self._path("")
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def __call__(self, df: DataFrame, name: str, replaces: str | None = None, rows: int | None = None) -> DataFrame:
        """``rows``: about how many there are, so that a small table is not written as many small files."""
        path = f"{self.root}/{name}"
        df = df if rows is None else df.coalesce(max(FEW_FILES, -(-rows // FILE_ROWS)))
        df.write.mode("overwrite").options(**_PLAIN_FILES).parquet(path)
        if replaces:
            self.drop(replaces)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path, files = self._path(name)
        files.delete(path, True)


def components(written: Written, edges: DataFrame, tag: str, rounds: int = 60) -> DataFrame:
    """(node, component): every node of ``edges`` (u, v) with the smallest node that it reaches.

    Labels take the minimum over neighbours, then the label of their label, until none changes; each round is
    written to the shared folder; edges are kept on the executors' disks and made again where one is lost. Rounds
    grow with the logarithm of a component's diameter. The minimum is pre-aggregated before its shuffle, so a node with
    very many edges costs one row for each task.
    """
    both = edges.where("u <> v").select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
    both = both.select("e.u", "e.v").distinct().persist(StorageLevel.DISK_ONLY)
    size = both.count()
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")), f"{tag}-0", rows=size)
    for k in range(1, rounds + 1):
        near = both.join(labels, both.v == labels.node).groupBy(F.col("u").alias("__u")).agg(F.min("component").alias("__least"))
        low = labels.join(near, labels.node == near["__u"]).select("node", F.least("component", "__least").alias("low"), F.col("component").alias("old"))
        up = low.select(F.col("node").alias("__node"), F.col("low").alias("__up"))  # made from the same exchanges
        labels = written(low.join(up, low.low == up["__node"]).select("node", F.least("low", "__up").alias("component"), "old"), f"{tag}-{k}", replaces=f"{tag}-{k - 1}", rows=size)
        changed = labels.where("component <> old").limit(1).count()
        labels = labels.select("node", "component")
        if not changed:
            both.unpersist()
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
