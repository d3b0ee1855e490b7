"""Hard-negative mining with exact integer scores by the method of the Four Russians.

An anchor's dimensions are taken eight at a time; a table of 256 entries holds
the sums of every subset. A candidate is cut into bit planes (two's
complement), packed eight dimensions to a byte, so a byte is an index into the
table. The planes are looked up from the highest down, shifted and added,
which gives the full inner product.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.tables import staged, tasks

#: Candidates and anchors that are scored at once: the sums stay in a core's cache.
ROWS, ANCHORS = 2048, 64
_LONG = 2**63 - 1


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """Two's-complement planes of int64 ``rows`` from the lowest up: bytes of shape (planes, groups of 8 columns, rows)."""
    n, d = rows.shape
    bits = max(int(rows.max(initial=0)).bit_length(), (~int(rows.min(initial=0))).bit_length()) + 1
    wide = np.zeros((n, -(-d // 8) * 8), np.int64)
    wide[:, :d] = rows
    return np.stack([np.packbits(((wide >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)])


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Tables of shape (groups, 256, anchors): the sum of every subset of each group of eight dimensions."""
    a = np.zeros((groups * 8, len(anchors)), kind)
    d = min(anchors.shape[1], groups * 8)
    a[:d] = anchors[:, :d].T
    table = np.zeros((groups, 256, len(anchors)), kind)
    for k in range(8):
        table[:, 1 << k: 2 << k] = table[:, : 1 << k] + a[k::8, None]
    return table


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products, candidates by anchors, of packed candidates and int64 anchors; exact whatever their size."""
    bits, groups, n = planes.shape
    most = max(abs(int(anchors.max(initial=0))), abs(int(anchors.min(initial=0)))) * groups * 8 << bits
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    out = np.zeros((n, len(anchors)), kind)
    for a in range(0, len(anchors), ANCHORS):
        tables = subset_sums(anchors[a: a + ANCHORS], groups, kind)
        for r in range(0, n, ROWS):
            some = planes[:, :, r: r + ROWS]
            total = np.zeros((some.shape[2], tables.shape[2]), kind)
            for b in range(bits - 1, -1, -1):
                total = total + total
                for g in range(groups):
                    found = tables[g][some[b, g]]
                    total = total - found if b == bits - 1 else total + found  # the top plane is the sign
            out[r: r + ROWS, a: a + ANCHORS] = total
    return out


def _packs(rows: DataFrame, size: int, planes: bool) -> DataFrame:
    """``id, label, v`` (and ``wins``) in packs of up to ``size`` rows, ordered by label and id.

    Candidates become bit planes; anchors stay int64 matrices and carry their
    positives' ids and scores (``wins``, alternating).
    """

    def pack(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(["label", "id"], kind="stable")
        m = np.zeros((len(some), max(map(len, some["v"]))), np.int64)
        for i, v in enumerate(some["v"]):
            m[i, : len(v)] = v
        out = {"ids": [some["id"].to_numpy(np.int64).tobytes()], "labels": [some["label"].to_numpy(np.int64).tobytes()]}
        if planes:
            cut = bit_planes(m)
            return pd.DataFrame(out | {"bits": [len(cut)], "planes": [cut.tobytes()]})
        wins = [np.array(w, np.int64) for w in some["wins"]]
        counts = np.array([len(w) // 2 for w in wins], np.int64)
        return pd.DataFrame(out | {"m": [m.tobytes()], "counts": [counts.tobytes()], "wins": [np.concatenate(wins).tobytes()]})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            held = part if held is None else pd.concat([held, part])
            while len(held) >= size:
                yield pack(held.iloc[:size])
                held = held.iloc[size:]
        if held is not None and len(held):
            yield pack(held)

    return rows.mapInPandas(run, "ids binary, labels binary, " + (
        "bits int, planes binary" if planes else "m binary, counts binary, wins binary"))


def _meet(packs: DataFrame, blocks: DataFrame, best: Callable, columns: str) -> DataFrame:
    """``best`` of every pack of candidates with every block of anchors; each pair meets in one cell of a grid.

    The grid has about four cells a shuffle partition, shaped so that both
    sides are copied about as much: a pack goes to as many cells as its row
    has. A cell scores what its copies let it, so copying never outgrows the
    scoring.
    """
    n, m, cells = packs.count(), blocks.count(), 4 * tasks(packs.sparkSession)
    wide = max(1, min(m, round(math.sqrt(cells * m / max(1, n)))))
    tall = max(1, min(n, cells // wide))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                ids, labels, own, own_labels = (np.frombuffer(x, np.int64) for x in (r.ids, r.labels, r.a_ids, r.a_labels))
                planes = np.frombuffer(r.planes, np.uint8)
                planes = planes.reshape(r.bits, len(planes) // (r.bits * len(ids)), len(ids))
                yield best(ids, labels, planes, own, own_labels, np.frombuffer(r.m, np.int64).reshape(len(own), -1),
                           np.frombuffer(r.counts, np.int64), np.frombuffer(r.wins, np.int64).reshape(-1, 2))

    left = packs.withColumn("_r", F.pmod(F.xxhash64("ids", "planes"), F.lit(tall))).withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(wide - 1).cast("long"))))
    right = blocks.select(F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), "m", "counts", "wins",
                          F.pmod(F.xxhash64("ids"), F.lit(wide)).alias("_c"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tall - 1).cast("long"))).alias("_r"))
    return left.join(right, ["_r", "_c"]).drop("_r", "_c").mapInPandas(run, columns)


def _clipped(found: np.ndarray) -> np.ndarray:
    return np.clip(found, -_LONG, _LONG).astype(np.int64) if found.dtype == object else found.astype(np.int64, copy=False)


def _frame(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i, c in enumerate(names)})


def _same_label(k: int) -> Callable:
    """The ``k`` best candidates of each anchor's own label in a pack."""

    def best(ids, labels, planes, own, own_labels, m, counts, wins):
        out = []
        for label in np.unique(own_labels):
            a, b = np.searchsorted(labels, [label, label + 1])
            c, d = np.searchsorted(own_labels, [label, label + 1])
            if a == b:
                continue
            found = _clipped(scores(planes[:, :, a:b], m[c:d]))
            for i in range(c, d):
                some = np.flatnonzero(ids[a:b] != own[i])
                score = found[some, i - c]
                if len(some) > k:
                    high = score >= np.partition(score, len(score) - k)[len(score) - k]
                    some, score = some[high], score[high]
                order = np.lexsort((ids[a:b][some], -score))[:k]
                out.append((np.full(len(order), own[i]), ids[a:b][some[order]], score[order]))
        return _frame(out, ["anchor_id", "positive_id", "score"])

    return best


def _other_label(k: int, low: int, high: int) -> Callable:
    """For each anchor and positive, the ``k`` best candidates of other labels in the positive's score window in a pack."""

    def best(ids, labels, planes, own, own_labels, m, counts, wins):
        out, found = [], _clipped(scores(planes, m))
        starts = np.concatenate([[0], np.cumsum(counts)])
        for i in range(len(own)):
            windows = [(n, int(p), int(s), -(-low * int(s) // 100), high * int(s) // 100)
                       for n, (p, s) in enumerate(wins[starts[i]: starts[i + 1]])]
            windows = [w for w in windows if w[3] <= w[4]]
            if not windows:
                continue
            score = found[:, i]
            some = np.flatnonzero((score >= min(w[3] for w in windows)) & (score <= max(w[4] for w in windows))
                                  & (labels != own_labels[i]) & (ids != own[i]))
            some = some[np.lexsort((ids[some], -score[some]))]
            falling = -score[some]
            for n, positive, its, least, most in windows:
                a = np.searchsorted(falling, -most)
                b = min(a + k, np.searchsorted(falling, -least, "right"))
                if a < b:
                    full = np.full(b - a, 1, np.int64)
                    out.append((full * own[i], full * n, full * positive, full * its, ids[some[a:b]], score[some[a:b]]))
        return _frame(out, ["anchor_id", "_p", "positive_id", "positive_score", "negative_id", "negative_score"])

    return best


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, pack_rows: int = 16384, block_rows: int = 512, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(scale * x); a score is the integer inner product
    with the anchor; higher scores come first, ties by smaller id. The
    positives of a row of ``anchors`` are the first ``positives`` rows of
    ``vectors`` with its label (all, if fewer). For each, the first
    ``negatives`` rows of other labels are returned whose score is at least
    ``low`` and at most ``high`` percent of the positive's. A negative positive
    score has an empty window.

    A row never meets a row of its own id. Rows take no part when their id,
    label or vector is null, or when the vector holds a component that is
    null, not finite or so large that scale * x isn't a long. Shorter vectors
    count as ending in zeros. Rows that repeat an id are candidates each. An
    anchor id that is listed twice is mined once, for its least label and
    vector. Scores are exact; one that isn't a long counts as the nearest
    long. Other columns aren't read. An empty table gives an empty result.

    Every candidate meets every anchor (a stated query set against all rows),
    packed, twice: the first pass scores only rows of the anchor's label. A
    pair of packs yields at most its best rows, which are cut again in each
    task before they cross a shuffle. No label, id or vector gathers rows in
    one task, however common.
    """
    fits = F.forall(vector_col, lambda c: F.coalesce(F.abs(F.lit(scale) * c.cast("double")) < F.lit(2.0**62), F.lit(False)))

    def ints(df: DataFrame) -> DataFrame:
        return (df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fits)
                .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.transform(vector_col, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v")))

    def first(df: DataFrame, by: list[str], score: str, n: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), "positive_id" if score == "score" else "negative_id")
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    packs = staged(_packs(ints(vectors), pack_rows, planes=True))
    asked = staged(ints(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("s")).select("id", "s.label", "s.v"))
    parts = -(-asked.count() // block_rows) or 1

    alone = asked.withColumn("wins", F.array().cast("array<long>")).repartition(parts)
    near = _meet(packs, staged(_packs(alone, block_rows, planes=False)), _same_label(positives),
                 "anchor_id long, positive_id long, score long")
    near = first(near, ["anchor_id"], "score", positives).groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("p"))
    wins = F.flatten(F.transform("p", lambda p: F.array(p["positive_id"], p["score"])))
    paired = asked.join(near, "id").select("id", "label", "v", wins.alias("wins")).repartition(parts)
    found = _meet(packs, staged(_packs(paired, block_rows, planes=False)), _other_label(negatives, low, high),
                  "anchor_id long, _p long, positive_id long, positive_score long, negative_id long, negative_score long")
    return first(found, ["anchor_id", "_p"], "negative_score", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
