"""Embedding near-dedup (operator 1): an exact metric range join.

Unit vectors at cosine c lie sqrt(2 - 2c) apart. A bounded sample of vectors serves as pivots; a vector belongs to
the cell of its nearest pivot. A partner of v in the cell of pivot q, at most eps from v, is no nearer to v's own
pivot p than to q, so by the triangle inequality v is copied to that cell only if it lies within eps of the cell's
border: (|v - q|^2 - |v - p|^2) / (2 |p - q|) <= eps, and within eps of the cell's radius. Of two cells that may
share a pair one takes the other's copies, chosen so that every cell takes from half of the others. Then cells join
independently: each vector meets the vectors of its cell and the copies, in blocks, by a product in double
precision. Cells with many vectors are split into sub-cells that share their pivot.

Equal vectors are one class with a weight before the join. A task gives one row for each vector that it linked (its
number of links there) and a spanning forest of the links, never the pairs; components follow from the forests.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
different lengths; a null id gets a null component of its own; equal rows count as vectors of their own; an empty
table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.llm.common import Written, components, small_batches, table

#: Vectors that a sub-cell should hold; pivots that are chosen at most (both are broadcast: 256 x dimension doubles).
CELL, PIVOTS = 4096, 256
BLOCK = 1024


class Cells:
    """Pivots, the radius of each cell and its number of sub-cells."""

    def __init__(self, pivots: np.ndarray, eps: float):
        self.pivots, self.eps = pivots, eps
        self.radius, self.split = np.full(len(pivots), np.inf), np.ones(len(pivots), np.int64)
        self.apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))

    def home(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cos = units @ self.pivots.T
        at = cos.argmax(axis=1)
        return at, np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(at)), at]))

    def copies(self, units: np.ndarray, home: np.ndarray) -> np.ndarray:
        """A row for each vector, a column for each cell: whether a partner may lie there."""
        cos, n = units @ self.pivots.T, np.arange(len(home))
        near = 1e-9 + self.eps
        gap = 2 * (cos[n, home][:, None] - cos)
        may = gap <= 2 * near * self.apart[home] + 1e-9
        may &= np.sqrt(np.maximum(0, 2 - 2 * cos)) <= self.radius[None, :] + near
        may[n, home] = True
        return may



def fold(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b) have joined what they label; a label is the least member's place."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        low, high = np.minimum(la, lb)[open_], np.maximum(la, lb)[open_]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def join_cell(home: np.ndarray, weight: np.ndarray, ids: np.ndarray, others: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], least: float):
    """Links of a cell's vectors among themselves and with copies: arrays id, links, root (one forest for all links)."""
    n = len(home)
    label, links = np.arange(n), np.zeros(n)
    out = []
    for s in range(0, n, BLOCK):
        a, b = np.nonzero(home[s : s + BLOCK] @ home.T >= least)
        a += s
        a, b = a[a != b], b[a != b]
        links += np.bincount(a, weights=weight[b], minlength=n)
        label = fold(label, a, b)
    for units, w, other in others:
        for s in range(0, len(units), BLOCK):
            a, b = np.nonzero(units[s : s + BLOCK] @ home.T >= least)
            if len(a):
                links += np.bincount(b, weights=w[s + a], minlength=n)
                got = np.bincount(a, weights=weight[b])
                heads, first = np.unique(a, return_index=True)
                lead = np.zeros(len(got), np.int64)
                lead[heads] = b[first]
                label = fold(label, lead[a], b)
                out.append((other[s + heads], got[heads], ids[b[first]]))
    linked = np.flatnonzero(links)
    out.append((ids[linked], links[linked], ids[label[linked]]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _vectors(column: pd.Series, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), dimension)


def dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, cell: int = CELL) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept, class_id (the least id with an equal vector)."""
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    written = Written(spark)
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    classes = written(v.where(valid).groupBy("v").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("weight")), "classes")
    d, n = classes.agg(F.max(F.size("v")), F.count("*")).first()
    if not n:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"), F.col("vec_id").alias("class_id"))

    def units_of(column: pd.Series) -> np.ndarray:
        x = np.zeros((len(column), d))
        for i, row in enumerate(column):  # shorter vectors are filled with zeros, which changes no distance
            x[i, : len(row)] = row
        x /= np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    wanted = min(PIVOTS, max(1, -(-n // cell)))
    sample = units_of(pd.Series([r.v for r in classes.orderBy(F.xxhash64("class_id"), "class_id").select("v").limit(wanted).collect()]))
    pivots = [sample[0]]
    for u in sample[1:]:
        if max(float(u @ q) for q in pivots) < 0.8:
            pivots.append(u)
    cells = Cells(np.array(pivots), float(np.sqrt(2 - 2 * least)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, far = cells.home(units_of(b["v"]))
            yield pd.DataFrame({"cell": at, "far": far})

    for r in classes.select("v").mapInPandas(measure, "cell long, far double").groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        cells.radius[r.cell], cells.split[r.cell] = r.far, -(-r.n // cell)
    cells.radius[np.isinf(cells.radius)] = -10.0  # nothing lives there
    first = np.concatenate(([0], np.cumsum(cells.split)))
    total = int(first[-1])
    owner = np.repeat(np.arange(len(cells.split)), cells.split)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            u = units_of(b["v"])
            at, _ = cells.home(u)
            ids = b["class_id"].to_numpy()
            own = first[at] + (ids * 2654435761 & 0xFFFFFFFF) % cells.split[at]
            step = (np.arange(total)[None, :] - own[:, None]) % total
            takes = (2 * step < total) | ((2 * step == total) & (own[:, None] < np.arange(total)[None, :]))
            i, c = np.nonzero(cells.copies(u, at)[:, owner] & takes & (step > 0))
            sizes = b["v"].map(len).to_numpy()
            raw = [x.tobytes() for x in u]
            i, c = np.concatenate((np.arange(len(b)), i)), np.concatenate((own, c))
            for s in range(0, len(i), 4096):
                j = i[s : s + 4096]
                yield pd.DataFrame({"size": sizes[j], "cell": c[s : s + 4096], "copy": s + np.arange(len(j)) >= len(b), "id": ids[j], "weight": b["weight"].to_numpy()[j], "unit": [raw[x] for x in j.tolist()]})

    dealt = classes.mapInPandas(deal, "size long, cell long, copy boolean, id long, weight long, unit binary").repartition(max(1, total), "size", "cell").sortWithinPartitions("size", "cell", "copy")

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
        """Pieces of batches that lie in one cell and are copies or not."""
        for b in batches:
            for key, part in b.groupby(["size", "cell", "copy"], sort=True):
                yield key, part

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from itertools import groupby

        for _, parts in groupby(runs(batches), key=lambda x: x[0][:2]):
            own, pending = [], None
            for key, part in parts:
                if key[2]:
                    pending = part
                    break
                own.append(part)
            if not own:
                continue
            mine = pd.concat(own)

            def others(pending=pending, parts=parts):
                for part in [pending] * (pending is not None):
                    yield _vectors(part["unit"], d), part["weight"].to_numpy(), part["id"].to_numpy()
                for _, part in parts:
                    yield _vectors(part["unit"], d), part["weight"].to_numpy(), part["id"].to_numpy()

            got = join_cell(_vectors(mine["unit"], d), mine["weight"].to_numpy(), mine["id"].to_numpy(), others(), least)
            for s in range(0, len(got[0]), 10_000):
                yield pd.DataFrame({"id": got[0][s : s + 10_000], "links": got[1][s : s + 10_000].astype(np.int64), "root": got[2][s : s + 10_000]})

    forest = written(dealt.mapInPandas(join, "id long, links long, root long"), "forest")
    links = forest.groupBy("id").agg(F.sum("links").alias("links"))
    reach = components(written, forest.select(F.col("id").alias("u"), F.col("root").alias("v")), "reach")
    known = classes.join(links, classes.class_id == links.id, "left").drop("id").join(reach, classes.class_id == reach.node, "left").select("v", "class_id", "weight", "links", "component")
    known = known.withColumnRenamed("v", "__v")
    out = v.withColumn("__valid", valid).join(known, F.col("__valid") & (F.col("v") == F.col("__v")), "left")
    component = F.coalesce("component", "class_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.coalesce("class_id", "vec_id").alias("class_id"),
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "embeddings"))
