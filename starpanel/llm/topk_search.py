"""Exact top-k search (operator 4): multi-resolution segment statistics.

A vector's segment of length n has a mean m and a deviation s (sqrt of the mean square about the mean). For two
vectors, |x - y|^2 >= sum of n ((m - m')^2 + (s - s')^2) over the segments, by Cauchy and Schwarz. As the inner
product is (|x|^2 + |y|^2 - |x - y|^2) / 2, the k-th best score found so far bounds the distance that a candidate may
have. Candidates are tested with few long segments, the survivors with more and shorter ones, and what is left is
computed exactly. Every candidate goes through every resolution.

Candidates lie in cells (at most 2^BITS) by which of their coarsest statistics exceed those of a seed sample. A cell
has an interval for each statistic, and so a bound on its scores with a query. The k-th best score of a query among
the seeds (at most SEEDS candidates) is the least that a result can have: a query meets a cell only if it may find
more there, and candidates are copied only to blocks of queries that meet their cell. Blocks are of bounded size. A
task keeps one block of queries, their best k, and one batch of candidates. Each task gives at most k rows per query;
a window keeps the best k of all. Vectors of the most common length have cells; those of other lengths share one.

Scores are exact integers. Where the components of two vectors are so large that a product may pass 2^53, bounds are
taken in extended precision with its rounding error, and what is left is multiplied in integers of any length; such
vectors are searched apart. A score is decimal(38, 0), null if it has more digits, which changes no rank.

Vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no part; vectors of
different lengths aren't compared; ties go to the smaller id; a row with the query's own id is the query itself; an id
with several vectors is one query, by its least vector; repeated rows are candidates each; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpanel.llm.common import Written, small_batches, table

#: Most queries and candidates in a block; candidates that a task holds at once; candidates that give the first bounds.
QUERY_BLOCK, CANDIDATE_BLOCK, BATCH, SEEDS, BITS = 4096, 8192, 1024, 2048, 8
#: Numbers of segments, coarse to fine.
LEVELS = (4, 16)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Weighted means, then weighted deviations: a product of two such rows bounds the inner product from above."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    size = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    around = np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, cuts[:-1], axis=1) / size
    return np.concatenate((mean * np.sqrt(size), np.sqrt(around * size)), axis=1)


def whole(v: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * v) in double precision."""
    with np.errstate(over="ignore"):
        return np.floor(scale * v)


class Best:
    """The k best candidates of each query of a block so far; scores that double precision holds exactly."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int, levels: tuple[int, ...], scale: float):
        self.ids, self.x, self.k, self.scale = ids, whole(v, scale), k, scale
        self.stats = {n: statistics(self.x, n) for n in levels}
        self.score = np.full((len(ids), k), -np.inf)
        self.who = np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Candidates in a batch: bounds from coarse to fine, then exact scores of those that are left."""
        x, worst = whole(v, self.scale), self.score[:, -1]
        slack = np.where(np.isfinite(worst), 1e-6 * (1 + np.abs(worst)), 0)  # a hair for rounding
        levels = iter(self.stats.items())
        n, own = next(levels)
        may = own @ statistics(x, n).T >= (worst - slack)[:, None]
        for n, own in levels:
            # Survivors row by row would cost more than one product while they are many.
            if may.sum() > may.size / 16:
                may &= own @ statistics(x, n).T >= (worst - slack)[:, None]
            else:
                a, b = np.nonzero(may)
                may[a, b] = np.einsum("ij,ij->i", own[a], statistics(x, n)[b]) >= (worst - slack)[a]
        may &= self.ids[:, None] != ids[None, :]
        if may.sum() > may.size / 16:
            score = self.x @ x.T
            a, b = np.nonzero(may & (score >= worst[:, None]))
            got = score[a, b]
        else:
            a, b = np.nonzero(may)
            got = np.einsum("ij,ij->i", self.x[a], x[b])
            held = got >= worst[a]
            a, b, got = a[held], b[held], got[held]
        if not len(a):
            return
        touched = np.unique(a)
        who = np.concatenate((self.who[touched].ravel(), ids[b]))
        score = np.concatenate((self.score[touched].ravel(), got))
        of = np.concatenate((np.repeat(touched, self.k), a))
        order = np.lexsort((who, -score, of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        kept = order[rank < self.k]
        self.score[touched] = score[kept].reshape(len(touched), self.k)
        self.who[touched] = who[kept].reshape(len(touched), self.k)

    def rows(self) -> pd.DataFrame:
        found = np.isfinite(self.score)
        score = [str(int(x)) for x in self.score[found]]
        return pd.DataFrame({"query_id": np.repeat(self.ids, self.k)[found.ravel()], "vec_id": self.who[found], "score": score})


class BestOfAny:
    """The same for components of any size, in integers of any length."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int, levels: tuple[int, ...], scale: float):
        self.ids, self.k, self.scale, self.levels = ids.tolist(), k, scale, levels
        self.v, self.x = v, [self.integers(row) for row in v.tolist()]
        self.long = scale * v.astype(np.longdouble)
        self.norm = np.sqrt((self.long**2).sum(axis=1)) + math.sqrt(v.shape[1])
        self.stats = {n: statistics(self.long, n) for n in levels}
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.ids]  # heaps of (score, -id)

    def integers(self, row: list[float]) -> list[int]:
        # From 2^53 on a double is an integer, and its product with the scale is made in integers too.
        p, q = float(self.scale).as_integer_ratio()
        return [math.floor(self.scale * c) if abs(c) < 2**53 else int(c) * p // q for c in row]

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        long = self.scale * v.astype(np.longdouble)
        norm = np.sqrt((long**2).sum(axis=1)) + math.sqrt(v.shape[1])
        stats = {n: statistics(long, n) for n in self.levels}
        exact: dict[int, list[int]] = {}
        for i, best in enumerate(self.best):
            # What floor and rounding may take off a bound.
            err = (self.norm[i] + norm) * math.sqrt(v.shape[1]) + 1e-15 * self.norm[i] * norm
            left = np.flatnonzero(ids != self.ids[i])
            if len(best) == self.k:
                for n in self.levels:
                    left = left[stats[n][left] @ self.stats[n][i] + err[left] >= np.longdouble(str(best[0][0]))]
            for j in left.tolist():
                if j not in exact:
                    exact[j] = self.integers(v[j].tolist())
                item = (sum(map(int.__mul__, self.x[i], exact[j])), -int(ids[j]))
                if len(best) < self.k:
                    heapq.heappush(best, item)
                else:
                    heapq.heappushpop(best, item)

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame([(q, -w, str(s)) for q, best in zip(self.ids, self.best) for s, w in best], columns=["query_id", "vec_id", "score"])


def _matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), size)


def _block_search(queries: DataFrame, candidates: DataFrame, parts: int, k: int, levels: tuple[int, ...], scale: float, kind: type) -> DataFrame:
    """The best k of each query in each block (size, qb, cell, cb) of queries and candidates (vec_id, v)."""
    by = ["size", "qb", "cell", "cb"]
    grid = queries.select(*by, F.lit(0).alias("role"), "vec_id", "v").unionByName(candidates.select(*by, F.lit(1).alias("role"), "vec_id", "v"))
    grid = grid.repartition(parts, *by).sortWithinPartitions(*by, "role")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, best, own = None, None, []
        for b in batches:
            for (*at, role), part in b.groupby([*by, "role"], sort=True):
                if at != block:
                    if best is not None:
                        yield best.rows()
                    block, best, own = at, None, []
                if role == 0:
                    own.append(part)
                elif own:
                    if best is None:
                        mine = pd.concat(own)
                        best = kind(mine["vec_id"].to_numpy(), _matrix(mine["v"], at[0]), k, levels, scale)
                    ids, v = part["vec_id"].to_numpy(), _matrix(part["v"], at[0])
                    for s in range(0, len(ids), BATCH):
                        best.meet(ids[s : s + BATCH], v[s : s + BATCH])
        if best is not None:
            yield best.rows()

    return grid.mapInPandas(run, "query_id long, vec_id long, score string")


class Cells:
    """Cells of vectors of one length: by which of their coarsest statistics, the most spread ones, exceed the seeds' median."""

    def __init__(self, ids: np.ndarray, seeds: np.ndarray, levels: tuple[int, ...], bits: int):
        self.ids, self.seeds, self.size, self.n = ids, seeds, seeds.shape[1], levels[0]
        s = statistics(seeds, self.n)
        self.split = np.argsort(-s.std(axis=0), kind="stable")[:bits]
        self.middle = np.median(s, axis=0)[self.split]
        self.low, self.high, self.count = {}, {}, {}

    def of(self, s: np.ndarray) -> np.ndarray:
        return ((s[:, self.split] > self.middle) << np.arange(len(self.split))).sum(axis=1)

    def meets(self, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The cells, and which of them may hold one of a query's k best, a row for each query."""
        cells = np.array(sorted(self.low))
        low, high = np.array([self.low[c] for c in cells]), np.array([self.high[c] for c in cells])
        s = statistics(x, self.n)
        most = np.maximum(s, 0) @ high.T + np.minimum(s, 0) @ low.T
        score = np.where(ids[:, None] == self.ids[None, :], -np.inf, x @ self.seeds.T)
        if score.shape[1] < k:
            return cells, np.ones(most.shape, bool)
        worst = np.sort(score, axis=1)[:, -k][:, None]
        return cells, ~(most < worst - 1e-6 * np.where(np.isfinite(worst), 1 + np.abs(worst), 0))


def _hashed(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % blocks


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = 64.0, levels: tuple[int, ...] = LEVELS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other rows.

    Components are floor(scale * x). ``is_query``: a condition on the id column, here named vec_id.
    """
    small_batches(vectors.sparkSession, 4096)
    written = Written(vectors.sparkSession)
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite)
    # The product of two vectors whose components are all below this is below 2^53.
    least = F.sqrt(F.lit(2.0**52) / F.size("v")) / scale - 1 / scale
    v = v.select("vec_id", F.size("v").alias("size"), F.exists("v", lambda x: F.abs(x) >= least).alias("large"), "v")
    asked = v.where(is_query).groupBy("vec_id").agg(F.min(F.struct("size", "v", "large")).alias("q")).select("vec_id", "q.size", "q.large", "q.v")
    n, n_large, m = v.agg(F.count("*"), F.count_if("large"), F.count_if(is_query)).first()
    across, down = max(1, -(-m // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))
    small = v.where(~F.col("large"))

    # Cells, from seeds of the most common length; their number follows the number of candidates.
    common = small.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    common = common["size"] if common else 0
    seeds = small.where(F.col("size") == common).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SEEDS).select("vec_id", "v").collect()
    cells = Cells(np.array([r.vec_id for r in seeds]), whole(np.array([r.v for r in seeds]), scale), levels, min(BITS, down.bit_length() - 1)) if seeds else None

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every candidate's cell, and its statistics if there are intervals to be made of them."""
        for b in batches:
            for size, part in b.groupby("size"):
                raw, cell, stat = np.array(part["v"].tolist(), np.float64), -1, None
                if size == common:
                    stat = statistics(whole(raw, scale), levels[0])
                    cell, stat = cells.of(stat), list(stat)
                yield pd.DataFrame({"vec_id": part["vec_id"], "size": size, "cell": cell, "stat": stat, "v": [x.tobytes() for x in raw]})

    dealt = written(small.select("vec_id", "size", "v").mapInPandas(deal, "vec_id long, size int, cell long, stat array<double>, v binary"), "dealt")
    ranges = dealt.where("cell >= 0").select("cell", F.posexplode("stat").alias("i", "s")).groupBy("cell", "i").agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("n"))
    for r in ranges.orderBy("cell", "i").collect():  # 2^BITS cells with 2 * levels[0] statistics at most
        cells.low.setdefault(r.cell, []).append(r.low)
        cells.high.setdefault(r.cell, []).append(r.high)
        cells.count[r.cell] = -(-r.n // CANDIDATE_BLOCK)
    counts = cells.count if cells else {}
    spread = max(1, -(-across // max(1, len(counts))))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every query with each block of each cell that it may find one of its k best in."""
        for b in batches:
            for size, part in b.groupby("size"):
                ids, raw = part["vec_id"].to_numpy(), np.array(part["v"].tolist(), np.float64)
                block = _hashed(ids, np.array(spread))
                if size == common and counts:
                    x = whole(raw, scale)
                    names, may = cells.meets(ids, x, k)
                    block += spread * cells.of(statistics(x, levels[0]))
                    i, c = np.nonzero(np.repeat(may, [counts[c] for c in names], axis=1))
                    cell, cb = np.repeat(names, [counts[c] for c in names])[c], np.concatenate([np.arange(counts[c]) for c in names])[c]
                else:
                    i = np.repeat(np.arange(len(ids)), down)
                    cell, cb = np.full(len(i), -1), np.tile(np.arange(down), len(ids))
                text = [x.tobytes() for x in raw]
                for s in range(0, len(i), 4096):
                    j = i[s : s + 4096]
                    yield pd.DataFrame({"size": size, "qb": block[j], "cell": cell[s : s + 4096], "cb": cb[s : s + 4096], "vec_id": ids[j], "v": [text[x] for x in j.tolist()]})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["cb"] = _hashed(b["vec_id"].to_numpy(), b["cell"].map(lambda c: counts.get(c, down)).to_numpy(np.int64)) if len(b) else b["vec_id"]
            yield b[["size", "cell", "cb", "vec_id", "v"]]

    queries = asked.where(~F.col("large")).select("vec_id", "size", "v").mapInPandas(meet, "size int, qb long, cell long, cb long, vec_id long, v binary")
    met = queries.select("size", "qb", "cell").distinct()
    candidates = dealt.select("size", "cell", "vec_id", "v").mapInPandas(blocks, "size int, cell long, cb long, vec_id long, v binary").join(met, ["size", "cell"])
    found = _block_search(queries, candidates, across * down, k, levels, scale, Best)

    if n_large:  # queries or candidates with large components
        bytes_of = F.udf(lambda x: np.array(x, np.float64).tobytes(), "binary")
        place, zero = F.xxhash64("vec_id"), F.lit(0).cast("long")
        for q, c in ((asked.where("large"), v), (asked.where(~F.col("large")), v.where("large"))):
            q = q.select("size", F.pmod(place, F.lit(across)).alias("qb"), F.lit(-1).alias("cell"), F.explode(F.sequence(zero, zero + (down - 1))).alias("cb"), "vec_id", bytes_of("v").alias("v"))
            c = c.select("size", F.explode(F.sequence(zero, zero + (across - 1))).alias("qb"), F.lit(-1).alias("cell"), F.pmod(place, F.lit(down)).alias("cb"), "vec_id", bytes_of("v").alias("v"))
            found = found.unionByName(_block_search(q, c, across * down, k, levels, scale, BestOfAny))
    # Integers of any length in order: by sign and number of digits, then by digits.
    below, digits = F.col("score").startswith("-"), F.ltrim("score", F.lit("-"))
    order = (F.desc(F.when(below, -F.length(digits)).otherwise(F.length(digits))), F.desc(F.when(~below, digits)), F.asc(F.when(below, digits)), F.asc("vec_id"))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", F.expr("try_cast(score AS decimal(38, 0))").alias("score"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumn("score", F.expr("try_cast(score AS bigint)"))


# Each query's scores as SQL: a row's components as a list, and the product summed over them.
ORACLE = """
WITH v AS (SELECT vec_id, embedding, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
a AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY len(embedding), embedding) AS r FROM v WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM a q JOIN v c ON q.r = 1 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
