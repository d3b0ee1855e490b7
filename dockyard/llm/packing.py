"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents of more than a third of the capacity are matched greedily, at most
two a sequence; smaller ones go where they leave the least room. Pieces of one
length are interchangeable, so the plan is made for the histogram of lengths,
which has at most ``capacity`` rows whatever the corpus holds; the pieces then
look up their places by length and rank.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.pretokens import Encoder
from dockyard.llm.tables import slices, staged


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer of a file, once a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def piece_encoder(path: str) -> Callable[[list[str]], list[Sequence[int]]]:
    """Ids of pre-tokens by the byte-level BPE model of the tokenizer file at ``path``."""
    model = _tokenizer(path).model
    # byte-level models spell each byte as one printable character
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spell = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return lambda pieces: [[t.id for t in model.tokenize(p.encode().decode("latin-1").translate(spell))] for p in pieces]


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the strings that the tokenizer file at ``path`` matches before its model sees a text."""
    tokens = _tokenizer(path).get_added_tokens_decoder()
    for t in tokens.values():
        if t.single_word or t.lstrip or t.rstrip:
            raise ValueError(f"{t.content}: added tokens that look at the text around them are not supported")
    return {t.content: i for i, t in tokens.items()}


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(piece_encoder(path), added=added_tokens(path))


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces: ``id, piece, start, length, ids`` (little-endian unsigned 32-bit ids).

    A document is its tokens and ``end_id``; null text counts as empty. Only
    documents longer than ``capacity`` are cut, into pieces of ``capacity``
    tokens of which the first may be shorter. ``_part`` and ``_rank`` number
    the pieces of one length inside a task; they are written with the rows, so
    they stay the same when a task is run again later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        part = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            keys = batch.column(0)
            at = 0
            for ids, counts in enc(texts):
                n = counts + 1
                whole = np.full(int(n.sum()), end_id, np.uint32)
                ends = np.cumsum(n)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                head = n - (parts - 1) * capacity
                length = np.where(piece == 0, head[doc], capacity)
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                order = np.argsort(length, kind="stable")
                same = length[order]
                first = np.searchsorted(same, same)
                rank = np.empty(len(same), np.int64)
                rank[order] = ranks[same] + np.arange(len(same)) - first
                np.add.at(ranks, length, 1)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                data = pa.BinaryArray.from_buffers(
                    pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at + doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     data, pa.array(np.full(len(doc), part, np.int32)), pa.array(rank)],
                    ["_id", "piece", "start", "length", "ids", "_part", "_rank"])
                at += len(n)

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")))
    return rows.mapInArrow(run, "_id long, piece int, start long, length long, ids binary, _part int, _rank long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequences as (how many, [(length, times), ...]) that hold ``counts[length]`` pieces each.

    Takes the lengths from the longest on. Above a third of the capacity, a
    length is matched with the longest partner that still fits. Below, pieces
    go to the sequences with the least room that is enough, and open new
    sequences only when none has room.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    open_: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # room -> kinds
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= capacity - n and left[m] > (m == n)), None)
            if mate is None:
                open_[capacity - n].append((left[n], ((n, 1),)))
                left[n] = 0
            elif mate == n:
                pairs = left[n] // 2
                open_[capacity - 2 * n].append((pairs, ((n, 2),)))
                left[n] -= 2 * pairs
            else:
                pairs = min(left[n], left[mate])
                open_[capacity - n - mate].append((pairs, ((n, 1), (mate, 1))))
                left[n] -= pairs
                left[mate] -= pairs
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            room = min((r for r, kinds in open_.items() if r >= n and kinds), default=None)
            if room is None:
                per = capacity // n
                new = -(-todo // per) if todo % per == 0 else todo // per
                if new:
                    open_[capacity - per * n].append((new, ((n, per),)))
                    todo -= new * per
                if todo:
                    open_[capacity - todo * n].append((1, ((n, todo),)))
                    todo = 0
                continue
            count, items = open_[room].pop()
            per = room // n
            full = min(count, todo // per)
            if full:
                open_[room - per * n].append((full, (*items, (n, per))))
                todo -= full * per
            if full < count and todo and todo < per:
                open_[room - todo * n].append((1, (*items, (n, todo))))
                todo, full = 0, full + 1
            if full < count:
                open_[room].append((count - full, items))
    return [(count, list(items)) for room in sorted(open_) for count, items in open_[room] if count]


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (of :func:`pieces_of`) with ``sequence_id`` and ``offset``.

    Every piece lies in one sequence; in a sequence, offsets run without gaps
    from 0 and the lengths sum to ``capacity`` at most. The driver sees the
    histogram of lengths only, and the plan it makes of it has a few thousand
    rows at most.
    """
    spark = pieces.sparkSession
    pieces = staged(pieces)
    # a full piece is a sequence of its own; their ids are negative
    full = pieces.filter(F.col("length") == capacity).select(
        "_id", "piece", "start", "length", "ids",
        (-1 - (F.col("_part").cast("long") * (1 << 36) + F.col("_rank"))).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pieces = pieces.filter(F.col("length") < capacity)
    by_part = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}

    rows, sequence = [], 0
    taken: dict[int, int] = defaultdict(int)
    for count, items in plan(counts, capacity):
        offset = 0
        for length, times in items:
            rows.append((length, taken[length], taken[length] + count * times, sequence, times, offset))
            taken[length] += count * times
            offset += length * times
        sequence += count
    places = spark.createDataFrame(rows, "length long, _lo long, _hi long, _seq long, _times long, _at long")

    ranked = pieces.join(first, ["_part", "length"]).withColumn("_r", F.col("_first") + F.col("_rank"))
    at = F.col("_r") - F.col("_lo")
    # at most a few rows a length: bounded by the capacity, not by the data
    p = F.broadcast(places.withColumnRenamed("length", "_length"))
    return (ranked.join(p, (F.col("length") == F.col("_length")) & (F.col("_r") >= F.col("_lo")) & (F.col("_r") < F.col("_hi")))
            .select("_id", "piece", "start", "length", "ids",
                    (F.col("_seq") + F.expr("(_r - _lo) div _times")).alias("sequence_id"),
                    (F.col("_at") + F.pmod(at, F.col("_times")) * F.col("length")).alias("offset"))
            .unionByName(full))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece with its ids and place.

    Ids may repeat or be null and other columns aren't read. An empty table
    gives an empty result.
    """
    return pack(pieces_of(docs, tokenizer, capacity, end_id, id_col, text_col), capacity).withColumnRenamed("_id", id_col)
