"""Byte-level BPE encoding and decoding with padded numpy matrices."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.pretokens import Encoder
from dockyard.llm.rolling import HashTable, ragged

NONE = np.int32(2**31 - 1)
_LONG = 512  # longer pieces merge through a heap: a matrix would take a round for each byte
#: Rows of a batch that are Python texts at once.
_ROWS = 512


class Vocabulary:
    """Ranks, the hashed table of mergeable pairs, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, merged = (np.array(x, np.int64) for x in zip(*pairs))
        self._pairs = HashTable(len(pairs))
        self._pairs.put((left << 32 | right).astype(np.uint64), merged)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(self.ranks.values()) + 1
        self._length = np.zeros(size, np.int64)
        by_id = [b""] * size
        for t, r in self.ranks.items():
            by_id[r] = t
            self._length[r] = len(t)
        self._begin = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id (and so the rank) that each pair merges to; NONE where there is none."""
        found = self._pairs.get((left.astype(np.int64) << 32 | right.astype(np.int64)).ravel().astype(np.uint64))
        real = (left.ravel() >= 0) & (right.ravel() >= 0) & (found >= 0)
        return np.where(real, found, NONE).astype(np.int32).reshape(left.shape)

    def encode_pieces(self, pieces: Sequence[str]) -> list[Sequence[int]]:
        raw = [p.encode() for p in pieces]
        out: list[Sequence[int]] = [()] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            r = self.ranks.get(b)
            if r is not None:
                out[i] = (r,)
            elif len(b) > _LONG:
                out[i] = self._merge_long(b)
            else:
                buckets.setdefault(len(b).bit_length(), []).append(i)
        for rows in buckets.values():
            self._merge_bucket(raw, rows, out)
        return out

    def _merge_bucket(self, raw: list[bytes], rows: list[int], out: list) -> None:
        """Pieces of similar length as one matrix; each round every row merges its leftmost lowest pair."""
        size = np.array([len(raw[i]) for i in rows])
        m = np.full((len(rows), size.max()), -1, np.int32)
        m[np.arange(size.max()) < size[:, None]] = self.byte[np.frombuffer(b"".join(raw[i] for i in rows), np.uint8)]
        at = np.array(rows)
        rank = self.merged(m[:, :-1], m[:, 1:])
        while len(at):
            where = rank.argmin(axis=1)
            low = rank[np.arange(len(at)), where]
            done = low == NONE
            if done.any():
                for i, row in zip(at[done].tolist(), m[done]):
                    out[i] = row[row >= 0].tolist()
                m, rank, at, where, low = m[~done], rank[~done], at[~done], where[~done], low[~done]
                if not len(at):
                    break
            # close the gap: columns after the merged pair move one to the left
            line = np.arange(len(at))
            keep = np.ones(m.shape, bool)
            keep[line, where + 1] = False
            m[line, where] = low
            m = m[keep].reshape(len(at), -1)
            if m.shape[1] == 1:
                for i, row in zip(at.tolist(), m):
                    out[i] = row.tolist()
                break
            keep = np.ones(rank.shape, bool)
            keep[line, where] = False
            rank = rank[keep].reshape(len(at), -1)
            # only the pairs beside the merged one have changed
            has = where < rank.shape[1]
            rank[line[has], where[has]] = self.merged(m[line[has], where[has]], m[line[has], where[has] + 1])
            has = where > 0
            rank[line[has], where[has] - 1] = self.merged(m[line[has], where[has] - 1], m[line[has], where[has]])

    def _merge_long(self, b: bytes) -> list[int]:
        """The same merges for one long piece, by a heap of (rank, position)."""
        ids = self.byte[np.frombuffer(b, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.merged(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                r = int(self.merged(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
                if r != NONE:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))

        while heap:
            r, i, a, c = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != c:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of all rows in a row, bytes per row) of rows of ``counts`` ids each."""
        size = self._length[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        stops = np.cumsum(counts)
        return self._bytes[ragged(self._begin[ids], size)], ends[stops] - ends[stops - counts]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path).encode_pieces)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>`` of every row's whole text by the rank file at ``path``.

    Null and empty texts have no ids. Each pre-token is merged by itself, as
    the rank file's own library does. Row by row: nothing is shuffled, ids may
    repeat or be null, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        # a slice at a time, so that few texts are Python strings at once
        for part in (b.slice(i, _ROWS) for b in batches for i in range(0, len(b), _ROWS)):
            at = 0
            for ids, counts in enc(part.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(at, len(counts)), _lists(ids, counts)], ["_id", "ids"])
                at += len(counts)

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")))
    return rows.mapInArrow(run, "_id long, ids array<int>").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` with ``decoded`` (binary), the bytes its ``ids`` stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            for a in range(0, len(lists), 256):
                some = lists.slice(a, 256)
                counts = np.diff(some.offsets.to_numpy())
                raw, size = vocab.decode(some.flatten().to_numpy(), counts)
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, 256), some, data.cast(pa.binary())], ["_id", "ids", "decoded"])

    return (encoded.select(F.col(id_col).cast("long").alias("_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
            .mapInArrow(run, "_id long, ids array<int>, decoded binary").withColumnRenamed("_id", id_col))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
