"""Token counts (operator 7): offset-mapped attribution.

A document is encoded once, as a whole. Every token has a span of characters (that of the characters whose bytes it
holds any of), sections have spans too, and an interval join of the two, both sorted, gives each token to a section.
A token that crosses a boundary goes by an explicit rule: to the section of its first character ("start"), of its
last ("end"), or to the one that holds most of its characters, the earlier of equals ("longest").

Sections are what lies between matches of a pattern; a match belongs to the section that it ends. Null and empty
texts have one section without tokens; a null id is kept; repeated rows each get their sections; an empty table
gives an empty table; other columns are not looked at. One pass over each whole text, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starpanel.llm.common import kept, small_batches, table
from starpanel.llm.merge_replay import _CHUNK, Codec, _codec, gathered

RULES = ("start", "end", "longest")


class _Store:
    """Chunks with their length in characters and the character spans of their tokens, in flat arrays."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.length = self.count = self.first = self.starts = self.ends = np.zeros(0, np.int64)

    def add(self, chunks: list[str], count: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if chunks:
            n = len(self.place)
            self.place.update(zip(chunks, range(n, n + len(chunks))))
            self.first = np.concatenate((self.first, len(self.starts) + np.cumsum(count) - count))
            self.length = np.concatenate((self.length, np.fromiter(map(len, chunks), np.int64, len(chunks))))
            self.count = np.concatenate((self.count, count))
            self.starts, self.ends = np.concatenate((self.starts, starts)), np.concatenate((self.ends, ends))

    def of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each chunk its length and number of tokens, and the spans of all these tokens within their chunks."""
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        count = self.count[at]
        token = np.arange(count.sum()) + np.repeat(self.first[at] - (np.cumsum(count) - count), count)
        return self.length[at], count, self.starts[token], self.ends[token]


class Spans(Codec):
    """Character spans of tokens; what was met last is kept in two generations of chunks."""

    def __init__(self, *a, **b):
        super().__init__(*a, **b)
        self.size, self.now, self.before = self.table.size, _Store(), _Store()
        self.sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, token in self.bytes_of.items():
            self.sizes[i] = len(token)

    def made(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, count = self.replay(chunks)
        stop = np.cumsum(self.sizes[ids])
        # From bytes to the characters that hold them, in all chunks as one text.
        lead = np.frombuffer("".join(chunks).encode(), np.uint8) & 0xC0 != 0x80
        of = np.cumsum(lead) - 1
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        base = np.repeat(np.cumsum(length) - length, count)
        return count, of[stop - self.sizes[ids]] - base, of[stop - 1] + 1 - base

    def enter(self, chunks: set[str]) -> None:
        new = chunks.difference(self.now.place)
        if len(new) + len(self.now.place) > self.size:
            self.before, self.now, new = self.now, _Store(), chunks
        old = self.before.place
        if again := [c for c in new if c in old]:
            self.now.add(again, *self.before.of(again)[1:])
        if new := [c for c in new if c not in old]:
            self.now.add(new, *self.made(new))

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all tokens of the texts, as if these stood one after the other."""
        chunks = [c for t in texts for c in _CHUNK.findall(t)]
        self.enter(set(chunks))
        length, count, starts, ends = self.now.of(chunks)
        base = np.repeat(np.cumsum(length) - length, count)
        return starts + base, ends + base


def attribute(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For each section (sorted starts) its tokens, and how many of those cross a boundary."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}: one of {RULES}")
    a = np.searchsorted(sections, starts, "right") - 1
    b = np.searchsorted(sections, ends - 1, "right") - 1
    own = (a if rule == "start" else b).copy()
    cross = np.flatnonzero(a != b)
    if rule == "longest":
        for k in cross:
            cuts = np.concatenate(([starts[k]], sections[a[k] + 1 : b[k] + 1], [ends[k]]))
            own[k] = a[k] + int(np.diff(cuts).argmax())
    return np.bincount(own, minlength=len(sections)), np.bincount(own[cross], minlength=len(sections))


def section_starts(text: str, boundary: re.Pattern) -> list[int]:
    """Where sections begin: at 0 and after each match but one at the end of the text."""
    n = len(text)
    return [0, *(m.end() for m in boundary.finditer(text) if m.end() > m.start() and m.end() < n)]


def count(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", boundary: str = r"\n", rule: str = "start"
) -> DataFrame:
    """One row per section: doc_id, section (from 0), start, end (code points), n_tokens, n_crossing."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, cut = kept(_codec, Spans, ranks_path, pattern), re.compile(boundary)
        for held, texts in gathered(batches):
            found = [section_starts(t, cut) for t in texts]
            each = np.fromiter(map(len, found), np.int64, len(found))
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            base = np.repeat(np.cumsum(size) - size, each)
            own = np.array([s for f in found for s in f], np.int64)
            # An empty text has no character that a section could hold: its section begins with the next text's.
            real = np.repeat(size, each) > 0
            starts, ends = codec.spans(texts)
            n, crossing = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            if len(starts):
                n[real], crossing[real] = attribute(starts, ends, (own + base)[real], rule)
            last = np.cumsum(each) - 1
            end = np.append(own[1:], 0)
            end[last] = size
            first = np.repeat(np.cumsum(each) - each, each)
            ids = pa.chunked_array([b.column(0) for b in held]).combine_chunks()
            cols = [ids.take(pa.array(np.repeat(np.arange(len(texts)), each))), np.arange(len(own)) - first, own, end, n, crossing]
            whole = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if isinstance(c, np.ndarray) else c for c in cols], names)
            for s in range(0, len(own), 20_000):
                yield whole.slice(s, 20_000)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
