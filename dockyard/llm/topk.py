"""Exact top-k by inner product with MaxScore over shards of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.tables import tasks


def max_score(query: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray,
              k: int, allowed: np.ndarray) -> np.ndarray:
    """Row numbers of every row that may be among the ``k`` best of a shard, ties included.

    A term is a dimension; its bound is the most it can add in this shard.
    Terms are taken by falling bound. The first (essential) ones are scored
    for all rows, until the others together could hardly lift a row over the
    k-th best; only rows that stay competitive are probed in the others.
    """
    bound = np.maximum(query * low, query * high)
    order = np.argsort(-np.abs(query * np.where(query > 0, high, low)), kind="stable")
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
    live = np.flatnonzero(allowed)
    score = np.zeros(len(live))
    step = max(8, len(order) // 4)
    for at in range(0, len(order), step):
        terms = order[at: at + step]
        score = score + rows[np.ix_(live, terms)] @ query[terms]
        if len(live) <= k:
            continue
        left = order[at + step:]
        top = live[np.argpartition(-score, k - 1)[:k]]
        theta = (rows[top] @ query).min() if len(left) else np.partition(score, len(score) - k)[len(score) - k]
        stay = score + rest[min(at + step, len(order))] >= theta
        live, score = live[stay], score[stay]
    return live


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, shard_rows: int = 4096,
          block_queries: int = 512, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vectors`` for each row of ``queries``.

    Components become floor(scale * x); the score is the integer inner product;
    ties go to the smaller id; a row never meets a row of its own id. Vectors
    that are null, hold null or non-finite components, or have a null id take
    no part; shorter vectors count as ending in zeros. Rows that repeat an id
    are candidates each. A query id that is listed twice is answered once, for
    the least of its vectors that take part (component by component).

    Vectors are packed into shards of about ``shard_rows`` rows and queries
    into blocks; every shard meets every block, which is a stated query set
    against all rows. Each meeting yields at most ``k`` rows a query (ties to
    the smaller id first), and these are ranked per query.
    """
    good = (F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()
            & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))

    def packed(df: DataFrame, size: int) -> DataFrame:
        ints = df.filter(good).select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for at in range(0, len(part), size):
                    some = part.iloc[at: at + size]
                    width = max(map(len, some["v"]))
                    m = np.zeros((len(some), width), np.int64)
                    for i, v in enumerate(some["v"]):
                        m[i, : len(v)] = v
                    yield pd.DataFrame({"ids": [some["id"].to_numpy(np.int64).tobytes()],
                                        "width": [width], "m": [m.tobytes()]})

        return ints.mapInPandas(run, "ids binary, width int, m binary")

    def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.qids, np.int64)
                width = max(r.width, r.qwidth)
                rows = np.zeros((len(ids), width))
                rows[:, : r.width] = np.frombuffer(r.m, np.int64).reshape(len(ids), -1)
                qs = np.zeros((len(qids), width))
                qs[:, : r.qwidth] = np.frombuffer(r.qm, np.int64).reshape(len(qids), -1)
                low, high = rows.min(0, initial=0), rows.max(0, initial=0)
                out = []
                for qid, q in zip(qids, qs):
                    live = max_score(q, rows, low, high, k, ids != qid)
                    score = (rows[live] @ q).astype(np.int64)
                    best = np.lexsort((ids[live], -score))[:k]
                    out.append((np.full(len(best), qid), ids[live][best], score[best]))
                yield pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]),
                                    "vec_id": np.concatenate([o[1] for o in out]),
                                    "score": np.concatenate([o[2] for o in out])})

    shards = packed(vectors, shard_rows)
    once = queries.filter(good).groupBy(id_col).agg(F.min(vector_col).alias(vector_col))
    blocks = packed(once, block_queries).select(
        F.col("ids").alias("qids"), F.col("width").alias("qwidth"), F.col("m").alias("qm"))
    # the shards and the blocks are dealt to a grid of cells; each pair meets in one cell
    spread = math.isqrt(4 * tasks(vectors.sparkSession)) + 1
    left = shards.withColumn("_r", F.pmod(F.xxhash64("ids"), F.lit(spread))).withColumn(
        "_c", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    right = blocks.withColumn("_c", F.pmod(F.xxhash64("qids"), F.lit(spread))).withColumn(
        "_r", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<bigint>")))
    met = left.withColumn("_c", F.col("_c").cast("long")).join(right, ["_r", "_c"]).select(
        "ids", "width", "m", "qids", "qwidth", "qm").mapInPandas(meet, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
