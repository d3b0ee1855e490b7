"""Key helpers: dense ids without a single-partition window, and first-wins
"insert if not there yet" guards evaluated on whole batches."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockyard.session import checkpoint_dir, shuffles_dropped

_IDX_BITS = 33  # monotonically_increasing_id = (partition << 33) + row index

# paths staged by the job or micro-batch that is running in this context
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate that several later steps read.

    The rows are written once as a parquet table under the shared checkpoint
    folder (spark.checkpoint.dir) and read back: later plans scan it instead
    of repeating its joins, a lost executor does not force a recompute from
    the sources, and the planner sees the real size of the table (so its
    broadcast decisions are size-checked). Inside :func:`staging` the table is
    deleted at the end of the block; elsewhere it stays, as the frame that is
    returned reads it."""
    spark = df.sparkSession
    path = staging_path(spark)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


def staging_path(spark) -> str:
    """A new folder under the shared checkpoint folder, deleted with the running :func:`staging` block."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    mine = _STAGED.get()
    if mine is not None:
        mine.append(path)
    return path


@contextmanager
def staging(spark):
    """Delete what the block stages when it ends, also when it fails. Frames
    that read staged tables are invalid afterwards; blocks of other threads
    keep their own lists."""
    mine: list[str] = []
    token = _STAGED.set(mine)
    try:
        yield
    finally:
        _STAGED.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in mine:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def assign_ids(df: DataFrame, keys: list[str], out_col: str = "_seq", start: int = 1,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = start + rank of the row's key in ``keys`` order.

    ``keys`` must be unique in ``df``. Ids depend only on the key order, not
    on the partition count. Two passes, no global window:

    1. range-partition the rows on the keys, sort inside each partition, tag
       each row with its partition and position, and stage the tagged rows
       (a table in the shared checkpoint dir) so both passes see the same tags;
    2. count rows per partition (one row per partition), turn the counts into
       offsets (a frame bounded by the partition count, broadcast), add.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    # the tags are stored, so both passes read the same numbers
    k = stage(df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    k = (k.withColumn("_pid", F.shiftrightunsigned("_mid", _IDX_BITS))
          .withColumn("_idx", F.col("_mid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1))))
    counts = k.groupBy("_pid").agg((F.max("_idx") + 1).alias("_n"))
    # At most `n` rows (one per partition): a single ordered window is cheap.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (k.join(F.broadcast(offs), "_pid")
            .withColumn(out_col, F.col("_off") + F.col("_idx") + F.lit(start))
            .drop("_pid", "_idx", "_mid", "_off"))


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the row with the smallest ``order`` value. Rows whose
    key has a NULL part are all kept (a NULL key never matches a guard).

    Uses a hash aggregate with ``min_by`` (partial, map-side), so a hot key
    is reduced before the shuffle instead of being sorted in one task."""
    cols = df.columns
    keyed = df.filter(_all_not_null(keys))
    loose = df.filter(~_all_not_null(keys))
    rest = [c for c in cols if c not in keys]
    best = (keyed.groupBy(*keys)
            .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_w"))
            .select(*keys, *[F.col("_w")[c].alias(c) for c in rest]))
    return best.select(*cols).unionByName(loose.select(*cols))


def first_wins_new(df: DataFrame, keys: list[str], order: str, existing: DataFrame | None,
                   existing_keys: list[str] | None = None) -> DataFrame:
    """First-wins inside the batch, then drop keys already in ``existing``
    (the guard reads the target, so a replayed batch adds nothing)."""
    out = first_wins(df, keys, order)
    if existing is None:
        return out
    ek = existing_keys or keys
    ex = existing.select(*[F.col(a).alias(b) for a, b in zip(ek, keys)]).distinct()
    return out.join(ex, keys, "left_anti")
