"""Byte-level BPE encoding and decoding (operator 8): corpus-level merge replay.

A task reads its documents a few million characters at a time. The distinct pieces of text in these form one corpus of symbols; an
inverted index from the rank of a token pair to the positions that hold it is built once, and merges are applied
in rank order over all pieces together. A merge touches its two neighbours only: their pairs leave the index and
the new pairs enter it. Pieces that a worker met lately keep their result, in a table of bounded size that outlives
a task, so common words are replayed once.

Null and empty texts have no ids and decode to nothing; repeated rows each get their own result; an empty table
gives an empty table. Columns other than the id and the text are not looked at. Text is split at white space as
the library does it, so any run of any length is handled; nothing is cut.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from starpanel.llm.common import Recent, kept, small_batches, table

#: Unicode White_Space, which is what the splitting pattern means by \s.
_SPACE = r"\t-\r \x85\xa0  -     　"
_SPACES = frozenset(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Coarser pieces that the splitting pattern never reaches across: a word with at most one space, or white space.
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_NONE = np.int32(2**31 - 1)
#: Bytes of words whose merges are replayed together; a longer word is replayed by itself.
CORPUS = 2_000_000


class Merges:
    """Which pairs of tokens merge, as sorted arrays: every split of a token into two tokens is one pair."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.wall = ranks, max(ranks.values()) + 1
        keys, into = [], []
        get = ranks.get
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None:
                    keys.append(a << 21 | b)
                    into.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.into = np.array(keys, np.int64)[order], np.array(into, np.int32)[order]
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        # Pairs of single bytes, and of a byte with a wall (row or column 256), straight from a table.
        of = np.append(self.single, self.wall)
        self.first = self.rank(np.repeat(of, 257), np.tile(of, 257)).reshape(257, 257)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes; _NONE where it makes none."""
        want = left.astype(np.int64) << 21 | right
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == want, self.into[at], _NONE)

    def alone(self, word: bytes) -> list[int]:
        """One word by itself: the lowest rank first, the leftmost of equal ranks first, from a heap of its pairs."""
        n, get = len(word), self.ranks.get
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if end[i] < 0 or j >= n or end[j] != stop:  # one of the two has changed meanwhile
                continue
            end[i], end[j], after[i] = stop, -1, after[j]
            if (k := after[i]) < n:
                before[k] = i
                if (r := get(word[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (h := before[i]) >= 0 and (r := get(word[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = after[i]
        return out

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (non-empty bytes) one after the other, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        part = np.cumsum(size) // CORPUS
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(words)]
        got = [self._replay(words[a:b], size[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]
        if not got:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])

    def _replay(self, words: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merges replayed over the words together, in rank order.

        ``index`` leads from a rank to the positions whose pair makes it. A word in which a merge brings up a
        pair of lower rank would have to leave the common order: it is set aside and encoded by itself.
        """
        start = np.cumsum(size + 1) - size  # a wall before each word and one at the end
        n = int(start[-1] + size[-1]) + 1
        inside = np.ones(n, bool)
        inside[start - 1] = inside[-1] = False
        byte = np.full(n, 256, np.int16)
        byte[inside] = np.frombuffer(b"".join(words), np.uint8)
        symbol = np.append(self.single, np.int32(self.wall))[byte]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        pair = np.full(n, _NONE, np.int32)
        pair[:-1] = self.first[byte[:-1], byte[1:]]
        mark = np.zeros(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        aside: set[int] = set()

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for a, b, r in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist()):
                if r in index:
                    index[r].append(places[a:b])
                else:
                    index[r] = [places[a:b]]
                    heapq.heappush(queue, r)

        def set_aside(places: np.ndarray) -> None:
            for w in np.unique(np.searchsorted(start, places, "right") - 1).tolist():
                aside.add(w)
                pair[start[w] : start[w] + size[w]] = _NONE

        live = np.flatnonzero(pair != _NONE)
        if len(live):
            enter(live, pair[live])
        while queue:
            rank = heapq.heappop(queue)
            lists = index.pop(rank)
            at = np.concatenate(lists) if len(lists) > 1 else lists[0]
            at = at[pair[at] == rank]
            if not len(at):
                continue
            at.sort()
            if len(at) > 1:
                if (again := at[1:] == at[:-1]).any():
                    at = at[np.concatenate(([True], ~again))]
                chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
                if chained.any():  # pairs that overlap: the leftmost goes first, then every other one
                    place = np.arange(len(at))
                    at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            second = after[at]
            right, left = after[second], before[at]
            made = np.full(len(at), rank, np.int32)
            ahead, behind = self.rank(made, symbol[right]), self.rank(symbol[left], made)
            if (low := (ahead < rank) | (behind < rank)).any():
                set_aside(at[low])
                stay = pair[at] == rank
                at, second, right, left, ahead, behind = at[stay], second[stay], right[stay], left[stay], ahead[stay], behind[stay]
                if not len(at):
                    continue
            symbol[at] = rank
            after[at] = right
            before[right] = at
            pair[second] = _NONE
            inside[second] = False
            if len(at) > 1 and (close := right[:-1] == at[1:]).any():  # neighbours that both merged just now
                joined = self.rank(np.array([rank]), np.array([rank]))[0]
                ahead[:-1][close] = joined
                left = before[at]
                if joined < rank:
                    set_aside(at[:-1][close])
                    gone = np.isin(np.searchsorted(start, at, "right"), np.array([w + 1 for w in aside]))
                    ahead[gone] = behind[gone] = _NONE
            pair[left] = behind
            pair[at] = ahead  # a left neighbour may be one of these: then this has its pair already
            mark[at] = True
            outer = ~mark[left] & (behind != _NONE)
            mark[at] = False
            new = ahead != _NONE
            places, ranks = np.concatenate((at[new], left[outer])), np.concatenate((ahead[new], behind[outer]))
            if len(places):
                enter(places, ranks)
        # What was not merged away: the symbols that are left, word by word.
        ids, count = symbol[inside], np.add.reduceat(inside, start, dtype=np.int64)
        if aside:
            cuts = np.cumsum(count) - count
            own = sorted(aside)
            found = [np.array(self.alone(words[w]), np.int32) for w in own]
            pieces, at = [], 0
            for w, f in zip(own, found):
                pieces += [ids[at : cuts[w]], f]
                at = cuts[w] + count[w]
                count[w] = len(f)
            ids = np.concatenate([*pieces, ids[at:]])
        return ids, count


class Codec:
    """Encoder and decoder of one vocabulary. ``size``: chunks in a generation of the table of results."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, size: int = 300_000):
        self.merges = Merges(ranks)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.table = Recent(size)

    def replay(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all chunks one after the other, and how many each chunk has."""
        # Chunks that are a space and a word give the same pieces in one text: a piece with a space begins a chunk.
        plain = np.fromiter((len(c) > 1 and c[0] == " " and c[1] not in _SPACES for c in chunks), bool, len(chunks))
        pieces = self.split("".join(itertools.compress(chunks, plain)))
        heads = np.flatnonzero(np.fromiter((p[0] == " " for p in pieces), bool, len(pieces)))
        each = np.zeros(len(chunks), np.int64)
        each[plain] = np.diff(np.append(heads, len(pieces)))
        if not plain.all():
            rest, at, out = {k: self.split(chunks[k]) for k in np.flatnonzero(~plain).tolist()}, 0, []
            last = 0
            upto = np.cumsum(each)
            for k, own in rest.items():
                stop = int(upto[k])
                out += pieces[last:stop]
                out += own
                last, each[k] = stop, len(own)
            pieces = out + pieces[last:]
        ids, count = self.merges.replay(list(map(str.encode, pieces)))
        upto = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], np.cumsum(each)))]
        return ids, np.diff(upto)

    def made(self, chunks: list[str]) -> Iterable:
        """What the table holds for each of these chunks: here its ids."""
        ids, count = self.replay(chunks)
        ids, stop = ids.tolist(), np.cumsum(count).tolist()
        return (ids[a:b] for a, b in zip([0, *stop], stop))

    def enter(self, chunks: set[str]) -> dict:
        """The table, with all of these chunks in it."""
        if new := self.table.missing(chunks):
            self.table.now.update(zip(new, self.made(new)))
        return self.table.now

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        chunks = [_CHUNK.findall(t) for t in texts]
        known = self.enter(set().union(*chunks))
        return [[i for c in cs for i in known[c]] for cs in chunks]


class _Digests(Codec):
    """Keeps, for each chunk, its ids in decimal and the bytes that those decode to."""

    def __init__(self, *a, **b):
        super().__init__(*a, **b)
        self.decimal = {i: str(i) for i in self.bytes_of}

    def made(self, chunks: list[str]) -> Iterable:
        ids, count = self.replay(chunks)
        ids, stop = ids.tolist(), np.cumsum(count).tolist()
        shown, back = list(map(self.decimal.__getitem__, ids)), list(map(self.bytes_of.__getitem__, ids))
        return ((" ".join(shown[a:b]), b"".join(back[a:b])) for a, b in zip([0, *stop], stop))

    def rows(self, texts: list[str]) -> list[tuple[int, str, str]]:
        chunks = [_CHUNK.findall(t) for t in texts]
        known = self.enter(set().union(*chunks))
        out = []
        for cs in chunks:
            got = [known[c] for c in cs]
            shown = " ".join([s for s, _ in got])
            back = b"".join([b for _, b in got])
            out.append((shown.count(" ") + bool(shown), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(back).hexdigest()))
        return out


def _codec(kind: type[Codec], ranks_path: str, pattern: str) -> Codec:
    return kind(read_ranks(ranks_path), pattern)


def gathered(batches: Iterator[pa.RecordBatch], chars: int = 4_000_000) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    """Arrow batches together with their texts (column 1), until these have so many characters."""
    held, texts, n = [], [], 0
    for batch in batches:
        got = [t or "" for t in batch.column(1).to_pylist()]
        held.append(batch)
        texts += got
        n += sum(map(len, got))
        if n >= chars:
            yield held, texts
            held, texts, n = [], [], 0
    if held:
        yield held, texts


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of each text."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(_codec, Codec, ranks_path, pattern)
        for batch in batches:  # ids are many times a text's memory: one batch at a time
            ids = codec.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes binary): what ids stand for; null ids give null."""
    rows = tokens.select(tokens[id_col].cast("long").alias("doc_id"), tokens[ids_col].cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {v: k for k, v in read_ranks(ranks_path).items()}
        for batch in batches:
            out = [None if ids is None else b"".join(map(of.__getitem__, ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return rows.mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): an encoding and its way back, as digests; a task keeps no ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(_codec, _Digests, ranks_path, pattern)
        for held, texts in gathered(batches):
            out = list(zip(*codec.rows(texts))) or [[], [], []]
            ids = pa.chunked_array([b.column(0) for b in held]).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
