"""Quality classifier (operator 3): attention-based multiple-instance learning.

A document is a bag of passages of about equal length, cut between words. A passage is encoded by the shares of its characters, hashed
pairs of characters and how its words repeat, then by a learned layer. Gated attention weighs the passages of a
document from document labels alone, and the weighted representation is scored. The model is fitted on the driver
to a sample of labelled documents: at most ``most`` ids (by order of a hash of the id), one row of each, and at most
``passages`` passages of a row, evenly spread over the whole text. Scoring is one pass over every passage of each
whole text, without a shuffle.

Null and empty texts are a bag with one empty passage and get a score like others; a null id is never a training row;
repeated rows are scored each, and the model sees the least text of an id; of labels that repeat, the mean decides, and null labels are left out; without
labels of both kinds every score is the share of label 1 (0.5 if there is no label). An empty table gives an empty
table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.llm.common import small_batches, table

PASSAGE, PAIRS, HIDDEN, GATE = 1000, 32, 16, 8
#: Most labelled documents that the model is fitted to, and most passages of each: 6000 * 32 * WIDTH floats, about 80 MB.
MOST, MOST_PASSAGES = 6000, 32
THRESHOLD = 0.3

_MARKS = [c for c in range(128) if not chr(c).isalnum()]
_GROUPS = np.zeros((256, len(_MARKS) + 4), np.float32)
for _k, _c in enumerate(_MARKS):
    _GROUPS[_c, _k] = 1
_GROUPS[65:91, -4] = _GROUPS[97:123, -3] = _GROUPS[48:58, -2] = _GROUPS[128:, -1] = 1
WIDTH = _GROUPS.shape[1] + PAIRS + 4


def encode(text: str | None) -> np.ndarray:
    """A row of features for each passage of the whole text."""
    raw = (text or "").encode()
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    n = max(1, -(-len(b) // PASSAGE))
    # A passage ends before the first white space at or after its full length, or there if it is inside a long word.
    full = np.arange(1, n) * PASSAGE
    spaces = np.append(np.flatnonzero(b <= 32), len(b) + PASSAGE)
    next_space = spaces[np.searchsorted(spaces, full)]
    cuts = [0, *np.where(next_space < full + PASSAGE, np.minimum(next_space, len(b)), full).tolist(), len(b)]
    at = np.repeat(np.arange(n), np.diff(cuts))
    size = np.maximum(np.diff(cuts), 1)[:, None]
    share = np.bincount(at * 256 + b, minlength=n * 256).reshape(n, 256) / size
    pair = np.bincount(at[1:] * PAIRS + ((b[:-1] * 31 + b[1:] * 7) & (PAIRS - 1)), minlength=n * PAIRS).reshape(n, PAIRS) / size if len(b) > 1 else np.zeros((n, PAIRS))
    words = np.zeros((n, 4))
    for i in range(n):
        w = raw[cuts[i] : cuts[i + 1]].split()
        if w:
            words[i] = len(set(w)) / len(w), sum(map(bytes.__eq__, w, w[1:])) / len(w), np.log1p(len(w)), size[i, 0] / len(w) / 10
    return np.concatenate((share @ _GROUPS, pair, words), axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionMIL:
    """Gated attention over passages: a ~ softmax(w . (tanh(V h) * sigmoid(U h))), score = sigmoid(c . sum(a h) + d)."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.mean, self.std, self.constant = np.zeros(WIDTH), np.ones(WIDTH), None
        scale = lambda *s: r.standard_normal(s) / np.sqrt(s[0])
        self.p = {"E": scale(WIDTH, HIDDEN), "e": np.zeros(HIDDEN), "V": scale(HIDDEN, GATE), "U": scale(HIDDEN, GATE), "w": scale(GATE), "c": scale(HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * s) @ p["w"]
        a = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "sizes": sizes, "y": _sigmoid(z @ p["c"] + p["d"])}

    def _plain(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -5, 5)

    def gradient(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy, by parameter."""
        p, f = self.p, self._forward(x, starts)
        g = (f["y"] - labels) / len(labels)
        spread = np.repeat(g[:, None] * p["c"], f["sizes"], axis=0)
        ga = (spread * f["h"]).sum(axis=1)
        gl = f["a"] * (ga - np.repeat(np.add.reduceat(f["a"] * ga, starts), f["sizes"]))
        gts = gl[:, None] * p["w"]
        gt, gs = gts * f["s"] * (1 - f["t"] ** 2), gts * f["t"] * f["s"] * (1 - f["s"])
        gh = (f["a"][:, None] * spread + gt @ p["V"].T + gs @ p["U"].T) * (1 - f["h"] ** 2)
        return {"E": x.T @ gh, "e": gh.sum(axis=0), "V": f["h"].T @ gt, "U": f["h"].T @ gs, "w": (f["t"] * f["s"]).T @ gl, "c": f["z"].T @ g, "d": g.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, steps: int = 300, rate: float = 0.02, decay: float = 1e-3) -> AttentionMIL:
        if len(bags) < 2 or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        x = np.concatenate(bags).astype(np.float64)
        starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])))[:-1]
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-4
        x, p = self._plain(x), self.p
        m, v = ({k: np.zeros_like(q) for k, q in p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            grad = self.gradient(x, starts, labels)
            for k, q in p.items():
                d = grad[k] + decay * q * (k not in "ed")
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                q -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None or not bags:
            return np.full(len(bags), self.constant if self.constant is not None else 0.5)
        starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])))[:-1]
        return self._forward(self._plain(np.concatenate(bags).astype(np.float64)), starts)["y"]


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, most: int = MOST, passages: int = MOST_PASSAGES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AttentionMIL:
    """A model of the labelled documents that ``train`` (a condition on the id, here named doc_id) lets in."""
    small_batches(docs.sparkSession)
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    known = known.where(train) if train is not None else known
    known = known.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text")).select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encode(t) for t in batch.column(1).to_pylist()]
            bags = [(b if len(b) <= passages else b[np.arange(passages) * len(b) // passages]).tobytes() for b in bags]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], ["y", "bag"])

    got = rows.mapInArrow(run, "y double, bag binary").collect()
    # Any order of rows gives the same sums only if it is one order: by content.
    got.sort(key=lambda r: (bytes(r.bag), r.y))
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, WIDTH) for r in got]
    return AttentionMIL().fit(bags, np.array([r.y for r in got]))


def score(docs: DataFrame, model: AttentionMIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): how likely label 1 is."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.score([encode(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def kept_documents(docs: DataFrame, model: AttentionMIL, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    k = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score([encode(t) for t in batch.column(k).to_pylist()]) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
