"""Near-duplicate detection with bottom-k sketches of one hash function.

A document's sketch is the ``k`` smallest hashes of its word shingles. Inverted
lists of retained values bring together documents that overlap; the sketch of
the union estimates their similarity; the exact Jaccard similarity of the full
sets decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.lists import linked_groups
from dockyard.llm.rolling import Rolling, mix
from dockyard.llm.tables import dropped, fresh, in_files, slices, staged

#: Rows that a file has, at least: of ids and hashes, and of sketches or what is made from them.
ROWS, SKETCHES = 1 << 16, 1 << 13
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes up to which a word's hash is polynomial; of longer ones it is a digest.
_LONG = 64
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def shingle_sets(texts: Sequence[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct 63-bit shingle hashes of each text in a row, how many each text has).

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer
    words than ``words`` has one shingle of all its words; without words, none.
    """
    raw = b"\n".join(t.encode() for t in texts) + b"\n"
    b = _LOWER[np.frombuffer(raw, np.uint8)]
    solid = np.concatenate([[False], ~_BLANK[b], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(t.encode()) + 1 for t in texts])
    doc = np.searchsorted(ends, start, "right")
    word = Rolling(b).of(start, end)
    for i in np.flatnonzero(end - start > _LONG):  # long words can be made to share a polynomial hash
        word[i] = int.from_bytes(hashlib.blake2b(b[start[i]: end[i]].tobytes(), digest_size=8).digest(), "little")
    n = np.bincount(doc, minlength=len(texts))
    run = np.zeros(len(word), np.uint64)
    for i in range(min(words, len(word))):  # hash of the words from here on, while they are of one text
        run[: len(word) - i] = run[: len(word) - i] * np.uint64(0x9E3779B97F4A7C15) + word[i:]
    last = np.arange(len(word)) + words - 1
    whole = last < np.repeat(np.cumsum(n), n)
    few = (n > 0) & (n < words)
    if few.any():
        first = np.cumsum(n) - n
        for d in np.flatnonzero(few):
            h = np.uint64(n[d])
            with np.errstate(over="ignore"):
                for w in word[first[d]: first[d] + n[d]]:
                    h = h * np.uint64(0xD1342543DE82EF95) + w
            run[first[d]], whole[first[d]] = h, True
    value, doc = mix(run[whole]) >> np.uint64(1), doc[whole]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[fresh].astype(np.int64), np.bincount(doc[fresh], minlength=len(texts))


def _blocks(texts: Sequence[str], size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _list(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _sketches(docs: DataFrame, words: int, k: int) -> DataFrame:
    """``_id, n, _set, _sketch``: size, 128-bit digest and bottom-k sketch of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            for a, b in _blocks(texts):
                values, n = shingle_sets(texts[a:b], words)
                stop = np.cumsum(n)
                parts = [values[e - c: e] for c, e in zip(n, stop)]
                kept = np.minimum(n, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n),
                     pa.array([hashlib.md5(p.tobytes()).digest() for p in parts], pa.binary()),
                     _list(np.concatenate([p[:k] for p in parts]), kept)], ["_id", "n", "_set", "_sketch"])

    return docs.mapInArrow(run, "_id long, n long, _set binary, _sketch array<long>")


#: Bits of the filter that keeps documents nobody asks for from being cut into shingles; it only saves work.
FILTER_BITS = 1 << 22


def _filter(need: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which every ``node`` of ``need`` has its bit."""
    at = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    words = need.select((at / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(node), {FILTER_BITS}) % 64 as int))").alias("bit"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.groupBy("w").agg(F.bit_or("bit").alias("bits")).collect():  # as many rows as the bitmap has words
        out[r["w"]] = r["bits"]
    return out


def _full_sets(docs: DataFrame, need: DataFrame, words: int) -> DataFrame:
    """``node, _full`` for the documents of ``need``; texts stay where they are read."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter(need))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in slices(batches):
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[at // 64] >> (at % 64)) & 1 == 1))
            texts = batch.column(1).to_pylist()
            for a, b in _blocks(texts):
                values, n = shingle_sets(texts[a:b], words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _list(values, n)], ["node", "_full"])

    rows = docs.filter("_id is not null").select("_id", "_text", F.pmod(F.xxhash64("_id"), F.lit(FILTER_BITS)).alias("_at"))
    return rows.mapInArrow(run, "node long, _full array<long>").join(need, "node", "left_semi")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, k: int = 64, list_size: int = 24,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked when the Jaccard similarity of their sets of
    ``words``-word shingles is ``percent`` per cent or more; a component's id
    is the smallest document id reachable, and that document is kept. A text
    without words is linked with nothing. Rows of one id count as one
    document; rows without an id are all kept, with a null component. Columns
    other than id and text are not read. An empty table gives an empty result.

    Equal sets meet by digest first, so copies cost one row each, and the
    rest works on one document per set. Of its retained values a document
    lists only the rarest: so many that two similar documents, whose sketches
    share well over half of their values (the chance of less is below 1e-7),
    must meet in a list. :func:`linked_groups` compares what meets.
    """
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    made = staged(_sketches(own, words, k))
    rows = made.count()
    sk = staged(made.select("_id", "n", "_set"))
    reps = staged(in_files(sk.filter("n > 0 and _id is not null").groupBy("_set").agg(F.min("_id").alias("_rep")), rows, ROWS))
    nodes = staged(in_files(made.join(reps.withColumnRenamed("_rep", "_id"), ["_set", "_id"])
                            .dropDuplicates(["_set"]).select(F.col("_id").alias("node"), "n", "_sketch"), rows, SKETCHES))
    dropped(made)

    # values are dealt once, for the count and for what is kept of them
    values = nodes.select("node", F.col("n").cast("int").alias("n"), F.explode("_sketch").alias("v"))
    common = values.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("v")).cast("int")).filter("c > 1")
    size = F.least(F.col("n"), F.lit(k))
    whole = k * percent // 100  # up to here the partner's sketch is its whole set as well
    overlap = F.when(F.col("n") <= whole, F.ceil(F.col("n") * percent / 100)).otherwise(F.floor(size * (percent / 100 - 0.3)))
    lists = (common.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("_l"))
             .withColumn("_take", F.size("_l") - overlap + 1)  # values of one document alone come first and need no list
             .filter("_take > 0")
             .select("node", F.col("n").cast("long").alias("n"), F.explode(F.slice("_l", F.lit(1), F.col("_take").cast("int"))["v"]).alias("v")))

    def promising(pairs: DataFrame) -> DataFrame:
        """Pairs whose similarity, estimated from the sketch of the union, may be high enough."""
        sa = nodes.select(F.col("node").alias("a"), F.col("_sketch").alias("_sa"))
        sb = nodes.select(F.col("node").alias("b"), F.col("_sketch").alias("_sb"))
        union = F.slice(F.sort_array(F.array_union("_sa", "_sb")), 1, k)
        both = F.size(F.array_intersect(F.array_intersect("_sa", "_sb"), F.col("_u")))
        return (pairs.join(sa, "a").join(sb, "b").withColumn("_u", union)
                .filter(both >= F.size("_u") * (percent / 100 - 0.3)).select("a", "b"))

    def sets(need: DataFrame) -> DataFrame:
        return _full_sets(own, staged(in_files(need, rows, ROWS)), words)

    groups = linked_groups(staged(in_files(lists, rows, SKETCHES)), percent, sets, list_size, promising, spent=[nodes])
    classes = reps.join(groups, F.col("_rep") == F.col("node"), "left").select(
        "_set", F.coalesce("component", "_rep").alias("component_id"))
    some = sk.filter("n > 0 and _id is not null").select("_id", "n", "_set").join(classes, "_set")
    none = sk.filter("n = 0 or _id is null").withColumn("component_id", F.col("_id"))
    out = some.select("_id", "n", "component_id").union(none.select("_id", "n", "component_id"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the one document of each group that :func:`near_groups` keeps; all columns stay."""
    gone = fresh(docs, "_gone")
    out = near_groups(docs, words, percent, id_col=id_col, text_col=text_col).filter("not kept").select(
        F.col(id_col).alias(gone)).distinct()
    return docs.join(out, F.col(id_col).cast("long") == F.col(gone), "left_anti")
