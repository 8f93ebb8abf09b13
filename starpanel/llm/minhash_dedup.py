"""MinHash near-dedup (operator 6): a multi-index Hamming join over b-bit signatures, confirmed on full sets.

A document's set holds its distinct shingles of five words. Equal sets are one class before anything is compared.
The signature has 64 positions, each the lowest 16 bits of one minimum. Two sets at the similarity asked for differ in
more than ``radius`` positions with a probability below 1e-7; every pair within the radius is found: positions
are split into radius // 2 + 1 chunks, so that by pigeonhole some chunk of the pair has at most one error, and each
class is entered once for each position that may be the error, under the rest of its chunk.

1. Buckets: a pass over entries sorted by key links each entry of a bucket to one hub of it (the entry that comes
   first in one order of all entries, so that buckets of the same entries share their hub), if the signatures are
   within the radius. Groups of such links are candidates.
2. A bucket whose entries still lie in several groups is compared entry by entry across groups, in a grid of blocks;
   groups that a pair connects are joined. Now every pair within the radius that shares a bucket lies in one group.
3. Groups are confirmed on full sets, recomputed from the whole texts: a group of up to BLOCK classes at once, a
   larger one twice by random blocks, and then in a grid of those outside the group's largest confirmed component
   against all. All pairs of a group are compared on one of these ways or already connected.

A task returns a spanning forest of its links, never its pairs, and holds two blocks at most. Null texts, empty texts and
texts without words have empty sets and link with nothing; a null id links with nothing and gets a null component;
repeated rows each get a row; equal ids count as one; an empty table gives an empty table; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpanel.llm.common import Written, components, small_batches, table
from starpanel.llm.embedding_dedup import fold

POSITIONS, BLOCK = 64, 512
#: Entries of a bucket that are compared by their signatures at once.
BUCKET_BLOCK = 2048
#: Rows without texts that are handed to a Python worker at once.
NARROW_ROWS = 10_000
_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray, k: int = 0) -> np.ndarray:
    h = h ^ np.uint64((k * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Sets of hashed shingles of texts. ``size``: words whose hashes are kept."""

    def __init__(self, width: int = 5, size: int = 400_000):
        self.width, self.size, self.known = width, size, {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        try:
            h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            new = set(words).difference(self.known)
            if len(self.known) + len(new) > self.size:
                self.known.clear()
                new = set(words)
            self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
            h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = min(self.width, len(words))
        last = len(words) - n + 1
        rolled = np.full(last, n, np.uint64)
        for i in range(n):
            rolled = rolled * _M + h[i : i + last]
        return np.unique(_mix(rolled))


_SEEDS = [(np.uint64(int.from_bytes(xxhash.xxh3_64_digest(f"a{i}"), "big")), np.uint64(int.from_bytes(xxhash.xxh3_64_digest(f"b{i}"), "big") | 1)) for i in range(POSITIONS)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit minima for each set; of an empty set, zeros."""
    out = np.zeros((len(sets), POSITIONS), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        every = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])))[:-1]
        for p, (a, b) in enumerate(_SEEDS):
            low = np.minimum.reduceat((every ^ a) * b, starts)
            out[full, p] = (_mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def radius(similarity: float, positions: int = POSITIONS, risk: float = 1e-7) -> int:
    """The least distance that two sets of this similarity exceed with at most this probability."""
    p = 1 - similarity
    tail, r = 1.0, -1
    while tail > risk:
        r += 1
        tail -= comb(positions, r) * p**r * (1 - p) ** (positions - r)
    return r


def entries(sig: np.ndarray, within: int) -> np.ndarray:
    """Keys of each signature, a column for each position that may be its chunk's error."""
    out = np.zeros(sig.shape, np.uint64)
    for chunk in np.array_split(np.arange(sig.shape[1]), within // 2 + 1):
        for wild in chunk:
            h = np.full(len(sig), int(wild) + 1, np.uint64)
            for p in chunk:
                if p != wild:
                    h = _mix(h * _M + sig[:, p].astype(np.uint64))
            out[:, wild] = h
    return out.view(np.int64)


def _signature_column(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), POSITIONS)


def _near(sa: np.ndarray, na: np.ndarray, sb: np.ndarray, nb: np.ndarray, within: int, percent: int) -> np.ndarray:
    differ = np.zeros((len(sa), len(sb)), np.uint8)
    for p in range(POSITIONS):
        differ += sa[:, p][:, None] != sb[:, p][None, :]
    low, high = np.minimum(na[:, None], nb[None, :]), np.maximum(na[:, None], nb[None, :])
    return (differ <= within) & (100 * low >= percent * high)


def confirmed(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets at ``left`` and ``right`` have 100 * intersection >= percent * union, as a matrix."""
    size = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(column, minlength=len(values)) > 1
    kept = shared[column]
    row, column = row[kept], (np.cumsum(shared) - 1)[column[kept]]
    both = np.zeros((len(left), len(right)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = int(shared.sum())
    for s in range(0, total, 8192):
        i, j = np.searchsorted(column, [s, s + 8192])
        has = np.zeros((len(sets), min(8192, total - s)), np.float32)
        has[row[i:j], column[i:j] - s] = 1
        both += has[left] @ has[right].T
    return 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)


def links(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """A spanning forest (u, v) of the links between places a and b."""
    label = fold(np.arange(len(ids)), a, b)
    at = np.flatnonzero(label != np.arange(len(ids)))
    return pd.DataFrame({"u": ids[label[at]], "v": ids[at]})


def near_dedup(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable), kept (whether it is its own)."""
    spark = docs.sparkSession
    small_batches(spark)
    written, within, percent = Written(spark), radius(similarity), round(100 * similarity)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            sets = [shingles.of(t) for t in batch.column(1).to_pylist()]
            sums = [_mix(s, 1).sum(dtype=np.uint64).view(np.int64) if len(s) else 0 for s in sets]
            xors = [np.bitwise_xor.reduce(_mix(s, 2)).view(np.int64) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums, pa.int64()), pa.array(xors, pa.int64()),
                pa.array([x.tobytes() for x in signatures(sets)], pa.binary()),
            ], ["doc_id", "n", "h1", "h2", "sig"])

    signed = written(rows.mapInArrow(sign, "doc_id long, n long, h1 long, h2 long, sig binary"), "signed")
    classes = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"))
    small_batches(spark, NARROW_ROWS)
    classes = classes.persist(StorageLevel.DISK_ONLY)  # two stages from what was written, for lost executors

    # 1. Buckets, each with a hub of its own.
    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = entries(_signature_column(b["sig"]), within)
            yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(b["id"].to_numpy(), keys.shape[1])})

    def bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Entries of keys that come up more than once, each with its bucket's first entry; batches are sorted by key."""
        before, hub, first_left = None, None, None
        for b in batches:
            key, ids = b["key"].to_numpy(), b["id"].to_numpy()
            new = np.concatenate(([key[0] != before], key[1:] != key[:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            hubs = np.where(start >= 0, ids[np.maximum(start, 0)], hub if hub is not None else 0)
            more = ~new  # not the first of its bucket
            # The first entry of a bucket follows once a second one is seen.
            lead = np.flatnonzero(new[:-1] & ~new[1:])
            out_key, out_id, out_hub = [key[more], key[lead]], [ids[more], ids[lead]], [hubs[more], ids[lead]]
            if not new[0] and first_left:
                out_key.append(key[:1]), out_id.append(np.array([hub])), out_hub.append(np.array([hub]))
            first_left = bool(new[-1]) if len(key) > 1 or new[-1] else False
            before, hub = key[-1], hubs[-1] if more[-1] else ids[-1]
            yield pd.DataFrame({"key": np.concatenate(out_key), "id": np.concatenate(out_id), "hub": np.concatenate(out_hub)})

    entered = classes.select("id", "sig").mapInPandas(enter, "key long, id long")
    entered = entered.repartition("key").sortWithinPartitions("key", F.xxhash64("id"), "id")
    members = entered.mapInPandas(bucket, "key long, id long, hub long").persist(StorageLevel.DISK_ONLY)
    sig = classes.select("id", "n", "sig")
    star = members.where("id <> hub").select("id", "hub").distinct()
    star = star.join(sig, "id").join(sig.select(F.col("id").alias("hub"), F.col("n").alias("n2"), F.col("sig").alias("sig2")), "hub")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            a, c = _signature_column(b["sig"]), _signature_column(b["sig2"])
            n, m = b["n"].to_numpy(), b["n2"].to_numpy()
            ok = ((a != c).sum(axis=1) <= within) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield pd.DataFrame({"u": b["hub"][ok], "v": b["id"][ok]})

    # An entry has a link to one hub, that of the first place in the order; that hub has links to the entry's others.
    # So links between hubs come up once for all entries that share them.
    hubs = star.mapInPandas(close, "u long, v long").groupBy("v").agg(F.array_sort(F.collect_set(F.struct(F.xxhash64("u").alias("place"), "u"))).alias("hubs"))
    one = F.col("hubs")[0]["u"]
    pairs = F.transform("hubs", lambda h, i: F.struct(F.when(i == 0, F.col("v")).otherwise(one).alias("u"), h["u"].alias("v")))
    group = components(written, hubs.select(F.inline(pairs)), "groups")

    # 2. Buckets that hold several groups still.
    placed = members.select("key", "id").join(group, F.col("id") == group.node, "left").select("key", "id", F.coalesce("component", "id").alias("g"))
    several = placed.groupBy("key").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count("*").alias("c")).where("low <> high").select("key", "c")
    open_ = _grid(placed.join(several, "key"), ["key"], "id", "c").join(sig, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, ["key", "i", "j"]):
            s, n, g = _signature_column(part["sig"]), part["n"].to_numpy(), part["g"].to_numpy()
            a, b = np.nonzero(np.triu(_near(s, n, s, n, within, percent) & (g[:, None] != g[None, :])))
            if len(a):  # groups are what is linked here, so a bucket gives fewer links than it has groups
                labels, place = np.unique(g, return_inverse=True)
                yield links(labels, place[a], place[b])

    joined = components(written, open_.mapInPandas(across, "u long, v long"), "joined-groups")
    onto = joined.select(F.col("node").alias("__g"), F.col("component").alias("__onto"))
    alone = joined.join(group, "node", "left_anti").select("node", "component")  # entries that had no link to a hub
    group = group.join(onto, group.component == onto["__g"], "left").select("node", F.coalesce("__onto", "component").alias("component")).unionByName(alone)

    # 3. Confirmation on full sets.
    size = group.groupBy("component").agg(F.count("*").alias("c"))
    group = written(group.join(size, "component").select(F.col("node").alias("id"), F.col("component").alias("g"), "c"), "group", rows=group.count())
    members.unpersist()
    small_batches(spark)
    texts = rows.join(group, rows.doc_id == group.id).select("id", "g", "c", "text")

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(width)
        for part in _groups(batches, ["g", "i", "j"]):
            part = part.drop_duplicates("id")
            sets, ids, side = [shingles.of(t) for t in part["text"]], part["id"].to_numpy(), part["side"].to_numpy()
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            ok = confirmed(sets, left, right, percent)
            a, b = np.nonzero(ok)
            a, b = left[a], right[b]
            if (a != b).any():
                yield links(ids, a[a != b], b[a != b])

    def by_blocks(df: DataFrame, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(F.col("c") / BLOCK))
        return df.select("id", "g", block.alias("i"), F.lit(0).cast("long").alias("j"), F.lit(2).alias("side"), "text")

    def checked(df: DataFrame) -> DataFrame:
        return df.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInPandas(confirm, "u long, v long")

    large = texts.where(F.col("c") > BLOCK)
    found = checked(by_blocks(texts, 1).unionByName(by_blocks(large, 2))).persist(StorageLevel.DISK_ONLY)
    held = [classes, found]
    if not group.where(F.col("c") > BLOCK).isEmpty():
        own = components(written, found, "confirmed-components")
        state = group.where(F.col("c") > BLOCK).join(own, F.col("id") == own.node, "left").select("id", "g", "c", F.coalesce("component", "id").alias("k"))
        state = written(state, "state", rows=state.count())
        w = Window.partitionBy("g").orderBy(F.desc("m"), "k")
        main = state.groupBy("g", "k").agg(F.count("*").alias("m")).withColumn("__r", F.row_number().over(w)).where("__r = 1").select("g", F.col("k").alias("main"))
        state = state.join(main, "g")
        outside = state.groupBy("g").agg(F.count_if(F.col("k") != F.col("main")).alias("o")).where("o > 0")
        state = state.join(outside, "g")
        blocks, places = F.ceil(F.col("o") / BLOCK), F.ceil(F.col("c") / BLOCK)
        here, there = F.pmod(F.xxhash64("id", F.lit(3)), blocks), F.pmod(F.xxhash64("id", F.lit(4)), places)
        zero = F.lit(0).cast("long")
        first = state.where(F.col("k") != F.col("main")).select("id", "g", here.alias("i"), F.explode(F.sequence(zero, places - 1)).alias("j"), F.lit(0).alias("side"))
        second = state.select("id", "g", F.explode(F.sequence(zero, blocks - 1)).alias("i"), there.alias("j"), F.lit(1).alias("side"))
        grid = first.unionByName(second).groupBy("id", "g", "i", "j").agg(F.when(F.count("*") > 1, 2).otherwise(F.first("side")).alias("side"))
        rest = checked(grid.join(large.select("id", "text").dropDuplicates(["id"]), "id"))
        found = found.union(rest).persist(StorageLevel.DISK_ONLY)
        held.append(found)
    reach = components(written, found, "reach")
    for done in held:
        done.unpersist()
    for done in ("state", "group"):
        written.drop(done)
    known = classes.join(reach, classes.id == reach.node, "left").select("n", "h1", "h2", F.coalesce("component", "id").alias("component"))
    out = signed.join(known, ["n", "h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _grid(df: DataFrame, by: list[str], id_col: str, count: str) -> DataFrame:
    """Rows dealt to pairs (i, j) of blocks, i <= j, so that any two rows of a group meet in one; few rows are one block."""
    blocks, zero = F.ceil(F.col(count) / BUCKET_BLOCK), F.lit(0).cast("long")
    df = df.withColumn("__b", F.pmod(F.xxhash64(*by, id_col), blocks)).withColumn("__o", F.explode(F.sequence(zero, blocks - 1)))
    return df.withColumn("i", F.least("__b", "__o")).withColumn("j", F.greatest("__b", "__o")).drop("__b", "__o")


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of batches that are sorted by these columns."""
    held = []
    for b in batches:
        key = b[by].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if held and (held[-1][by].to_numpy()[-1] != key[0]).any():
            yield pd.concat(held)
            held = []
        for s, e in zip([0, *cuts], [*cuts, len(b)]):
            if s:
                yield pd.concat(held)
                held = []
            held.append(b.iloc[s:e])
    if held:
        yield pd.concat(held)


def kept_documents(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are their component's smallest id, with all their columns."""
    kept = near_dedup(docs, similarity, id_col, text_col).where(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs[id_col] == kept["__kept"], "left_semi").unionByName(docs.where(docs[id_col].isNull()))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), similarity=0.85)
