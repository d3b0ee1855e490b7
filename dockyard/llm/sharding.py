"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by a
seeded hash of each record's place in the table. Pass two orders each bucket by
a seeded Fisher-Yates shuffle and writes it. The buckets one after another are
the shuffled corpus, and equal ranges of it are the shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from dockyard.llm.tables import fresh, staged, tasks

#: Bytes of text a bucket holds on average, at most.
BUCKET_BYTES = 32 << 20
#: Rows of the table of buckets (16 bytes each) up to which it goes to every task whole.
BROADCAST_ROWS = 1 << 18
#: Buckets whose counts are added up in one task.
RUN = 4096


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform order of 0 to n - 1: from the last place down, each swaps with one at or before it."""
    order = list(range(n))
    if n > 1:
        down = np.arange(n - 1, 0, -1)
        for i, j in zip(down.tolist(), rng.integers(0, down + 1).tolist()):
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _mixed(docs: DataFrame, buckets: int, seed: int, bucket: str, at: str) -> DataFrame:
    """``docs`` with each row's ``bucket`` and its place ``at`` inside."""
    place = fresh(docs, "_place")
    dealt = docs.withColumn(place, F.monotonically_increasing_id()).withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(place)), F.lit(buckets)))
    out = StructType([*docs.schema.fields]).add(bucket, LongType()).add(at, LongType())

    def order(key: tuple, table: pa.Table) -> pa.Table:
        # the rows of a bucket arrive in any order, so a repeated task sorts them before it shuffles them
        number = key[0].as_py()
        mix = fisher_yates(len(table), np.random.default_rng([seed % 2**63, number]))
        rows = np.argsort(table.column(place).to_numpy())[mix]
        return (table.drop_columns([place, bucket]).take(pa.array(rows))
                .append_column(bucket, pa.array(np.full(len(rows), number)))
                .append_column(at, pa.array(np.arange(len(rows)))))

    return dealt.groupBy(bucket).applyInArrow(order, out)


def _starts(counts: DataFrame, bucket: str, start: str) -> DataFrame:
    """``bucket`` and the rows ``_n`` of all buckets before it: sums over runs of buckets, then inside each run."""
    counts = counts.withColumn("_run", F.floor(F.col(bucket) / RUN))
    runs = counts.groupBy("_run").agg(F.sum("_n").alias("_all"))
    runs = runs.select("_run", (F.sum("_all").over(Window.orderBy("_run")) - F.col("_all")).alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy("_run").orderBy(bucket)) - F.col("_n")
    return counts.withColumn("_in", inside).join(runs, "_run").select(bucket, (F.col("_before") + F.col("_in")).alias(start))


def shard(docs: DataFrame, shards: int = 8, seed: int = 0, text_col: str = "text", shard_col: str = "shard",
          slot_col: str = "slot", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` in uniformly random order: all columns, ``shard`` int and ``slot`` long.

    The law is ``rows``: shards differ by one row at most (the first ones are
    the longer), and the slots of a shard are gapless from 0. The same rows in
    the same files with the same seed give the same result.

    Every row is placed by its position, not by its id or text, so repeated
    rows, equal texts, ids that most rows share, null ids and null texts are
    all spread alike. Fewer rows than shards leave the last shards empty; an
    empty table gives an empty result. A very long text makes its own bucket
    larger, no other. Columns of ``docs`` that are named ``shard_col`` or
    ``slot_col`` are replaced; other names are free.

    ``docs`` must be read from files or from a written table: a task that is
    run again must see its rows in the same order. The records are shuffled
    once and written once; buckets number at least four a shuffle partition,
    so one task has several.
    """
    docs = docs.drop(shard_col, slot_col)
    bucket, at, start = fresh(docs, "_bucket"), fresh(docs, "_at"), fresh(docs, "_start")
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    buckets = max(-(-size // bucket_bytes), 4 * tasks(docs.sparkSession))
    mixed = staged(_mixed(docs, buckets, seed, bucket, at))

    counts = staged(mixed.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n").alias("n")).first()["n"] or 0
    starts = _starts(counts, bucket, start)
    placed = mixed.join(F.broadcast(starts) if buckets <= BROADCAST_ROWS else starts, bucket)

    base, extra = divmod(total, shards)
    long_rows = extra * (base + 1)  # rows of the shards that have one more
    position = F.col(start) + F.col(at)
    first, rest = F.lit(base + 1), F.lit(max(base, 1))
    number = F.when(position < long_rows, F.floor(position / first)).otherwise(extra + F.floor((position - long_rows) / rest))
    slot = F.when(position < long_rows, F.pmod(position, first)).otherwise(F.pmod(position - long_rows, rest))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns],
                         number.cast("int").alias(shard_col), slot.cast("long").alias(slot_col))


def write_shards(placed: DataFrame, path: str, shard_col: str = "shard") -> None:
    """The records of :func:`shard` as Parquet, one folder a shard; every file holds runs of consecutive slots.

    A bucket is written by the task that reads it: nothing is shuffled again.
    """
    placed.write.partitionBy(shard_col).option("compression", "zstd").parquet(path)
