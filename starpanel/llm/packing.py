"""Packing (operator 5): along a space-filling curve.

A document becomes a hashed vector of its byte trigrams, projected to three dimensions by a fixed random matrix;
its place on the Hilbert curve through that space is its key. Documents are range-partitioned and sorted by
(key, id), so that neighbours on the curve are packed together, and each partition fills sequences one after the
other, cutting a document wherever a sequence ends. What is left at the end of a partition is cut into sequences
whose lengths are powers of two, which need no padding: no sequence holds any.

A hash of id and row is part of the range key, so copies of one text, which share a key, still spread over
partitions, repeated rows too. A task holds one Arrow batch and one open sequence. Null and empty texts are the end id alone; a null id is kept; every
repeated row is packed; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.llm.common import Recent, kept, small_batches, table

CAPACITY, END = 4096, 2
DIMENSIONS, BITS, BUCKETS = 3, 10, 512
#: Rows sampled for each partition, to place where partitions begin.
SAMPLE = 200

_WORD = re.compile(r"[^\t-\r \x85\xa0  -     　]+")


# Letters that stay one letter when they are composed and put in lower case, and marks that never join them in a piece.
_LETTERS = re.compile(r"([a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Ids of a tokenizer that drops white space, as bytes (unsigned 32-bit, little-endian), word by word.

    Added tokens are found in a text as it stands, before anything else, as the library does it.
    ``size``: words in a generation of the table of results.
    """

    def __init__(self, path: str, size: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # words hold no added token
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {" " + t: i.to_bytes(4, "little") for t, i in added.items()}  # no word begins with a space
        self.cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or "(?!)")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.table = Recent(size)

    def words(self, text: str) -> list[str]:
        # ASCII letters in lower case from here on: the tokenizer would do it, and fewer words differ.
        if not self.cut.search(text):
            return _WORD.findall(text.lower() if text.isascii() else text.encode().lower().decode())
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*_WORD.findall(text[at : m.start()].encode().lower().decode()), " " + m.group()]
            at = m.end()
        return out + _WORD.findall(text[at:].encode().lower().decode())

    def encode(self, words: list[str], at_once: int) -> list[bytes]:
        """The ids of each word. ``at_once``: words in one call, of which each must be a single piece if there are several."""
        texts = words if at_once == 1 else [" ".join(words[i : i + at_once]) for i in range(0, len(words), at_once)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), "<u4")
        stop = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) if at_once == 1 else np.flatnonzero(self.ends[flat]) + 1
        if len(stop) != len(words):
            return self.encode(words, 1)
        raw, stop = flat.tobytes(), (4 * stop).tolist()
        return [raw[a:b] for a, b in zip([0, *stop], stop)]

    def learn(self, words: set[str]) -> None:
        """Has all of these words in the table. A word of letters before marks is put together from the two."""
        parts = {w: m.groups() for w in words.difference(self.table.now) if (m := _LETTERS.fullmatch(w))}
        new = self.table.missing(words.union(*parts.values()) - {""})
        known = self.table.now
        whole, odd, joined = [], [], []
        for w in new:
            if (got := parts.get(w)) is None:
                (whole if _LETTERS.fullmatch(w) else odd).append(w)
            else:
                (joined if got[1] else whole).append(w)
        known.update(zip(whole, self.encode(whole, 50)))
        known.update(zip(odd, self.encode(odd, 1)))
        for w in joined:
            letters, marks = parts[w]
            known[w] = known[letters] + known[marks]
        known.update(self.added)

    def batch(self, texts: list[str]) -> list[bytes]:
        words = [self.words(t) for t in texts]
        self.learn(set().union(*words))
        of = self.table.now.__getitem__
        return [b"".join(map(of, w)) for w in words]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2**bits (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> b & 1)
    return out


_PROJECT = np.random.default_rng(7).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(texts: pa.Array) -> np.ndarray:
    """The Hilbert key of each text; nulls are like empty texts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint16)
    hashed = (raw[:-2] * 7 + raw[1:-1] * 61 + raw[2:] * 397) & BUCKETS - 1
    vectors = np.zeros((len(texts), BUCKETS))
    ends = (offsets - offsets[0]).tolist()
    for k, (a, b) in enumerate(zip(ends, ends[1:])):
        if b - a > 2:
            vectors[k] = np.bincount(hashed[a : b - 2], minlength=BUCKETS)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    spread = np.tanh(vectors @ (_PROJECT - _PROJECT.mean(axis=0)) * 0.7)
    return hilbert(np.clip(((spread + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1))


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Fills sequences. ``put`` and ``rest`` give (sequence, offset, doc_id, start, bytes, doc_tokens) of finished ones."""

    def __init__(self, first: int, capacity: int):
        self.sequence, self.capacity = first, capacity
        self.open: list[tuple] = []
        self.fill = 0

    def put(self, doc_id, ids: bytes) -> list[tuple]:
        out, total, start = [], len(ids) // 4, 0
        while start < total:
            n = min(self.capacity - self.fill, total - start)
            self.open.append((self.sequence, self.fill, doc_id, start, ids[4 * start : 4 * (start + n)], total))
            start += n
            self.fill += n
            if self.fill == self.capacity:
                out += self.open
                self.open, self.fill, self.sequence = [], 0, self.sequence + 1
        return out

    def rest(self) -> list[tuple]:
        """The open sequence, cut again into sequences of a power of two each."""
        out, sizes = [], powers(self.fill)
        room, used = (sizes.pop(0) if sizes else 0), 0
        for _, _, doc_id, start, ids, total in self.open:
            while ids:
                n = min(room - used, len(ids) // 4)
                out.append((self.sequence, used, doc_id, start, ids[: 4 * n], total))
                ids, start, used = ids[4 * n :], start + n, used + n
                if used == room:
                    self.sequence += 1
                    room, used = (sizes.pop(0) if sizes else 0), 0
        self.open, self.fill = [], 0
        return out


def along_curve(rows: DataFrame) -> DataFrame:
    """(doc_id, text) range-partitioned and sorted by the Hilbert key, equal keys in a hashed order of ids and rows.

    A text's key is computed once. Where partitions begin is taken from the keys of a random sample, SAMPLE rows for
    each partition; every row is then placed by its own key.
    """
    parts, n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count()
    rows = rows.withColumn("tie", F.xxhash64("doc_id", F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFFFFFF)))

    def key(texts: pa.Array, ties: pa.Array) -> np.ndarray:
        return curve_keys(texts) << 32 | ties.to_numpy(zero_copy_only=False)

    @F.arrow_udf("long")
    def place(texts: pa.Array, ties: pa.Array) -> pa.Array:
        return pa.array(key(texts, ties))

    share = min(1.0, SAMPLE * parts / max(1, n))
    seen = np.sort(np.array([r[0] for r in rows.sample(share, 1).select(place("text", "tie")).collect()], np.int64))
    begins = seen[(np.arange(1, parts) * len(seen)) // parts] if len(seen) else seen

    @F.arrow_udf("struct<place:long,part:int>")
    def placed(texts: pa.Array, ties: pa.Array) -> pa.Array:
        at = key(texts, ties)
        return pa.StructArray.from_arrays([pa.array(at), pa.array(np.searchsorted(begins, at, "right").astype(np.int32))], ["place", "part"])

    at = rows.select("doc_id", "text", placed("text", "tie").alias("at")).select("doc_id", "text", "at.place", "at.part")
    return at.repartitionById(parts, "part").sortWithinPartitions("place", "doc_id").select("doc_id", "text")


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END, ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves.

    ``ids``: whether the pieces' ids (binary, unsigned 32-bit, little-endian) are returned too.
    """
    small_batches(docs.sparkSession)
    rows = along_curve(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")))
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * ids

    def out(pieces: list[tuple]) -> pa.RecordBatch:
        s, o, d, at, raw, total = zip(*pieces)
        cols = [pa.array(c, pa.int64()) for c in (d, at, [len(r) // 4 for r in raw], [zlib.crc32(r) for r in raw], total, s, o)]
        return pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * ids, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, words = Packer(TaskContext.get().partitionId() << 40, capacity), None
        for batch in batches:
            words = words or kept(WordIds, tokenizer_path)
            done = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), words.batch([t or "" for t in batch.column(1).to_pylist()])):
                done += packer.put(doc_id, raw + end)
            if done:
                yield out(done)
        if done := packer.rest():
            yield out(done)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names[:7]) + ", ids binary" * ids)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)
