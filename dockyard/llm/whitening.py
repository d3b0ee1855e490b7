"""Embedding whitening through a covariance weighted by multiplicity.

Equal vectors are grouped first; a group enters the fit once, with its number
of rows (or one) as its weight, is whitened once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.tables import staged

#: Vector entries that are worked on at once.
ENTRIES = 1 << 19
_DECIMAL = pa.decimal128(38, 0)


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slices of a batch: first row, row after the last, the int64 matrix of the list column there."""
    lists = batch.column(column)
    width = len(lists[0]) if len(lists) else 0
    step = max(1, ENTRIES // max(1, width))
    for at in range(0, len(lists), step):
        some = lists.slice(at, step)
        yield at, at + len(some), some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), width)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def _decimals(values: list[int]) -> pa.Array:
    """Exact numbers; null where one has more than 38 digits."""
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in values], _DECIMAL)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the exact weighted sum of each dimension."""
    sums: list[int] = []
    for batch in batches:
        weight = batch.column("w").to_numpy()
        for a, b, x in _matrices(batch, "x"):
            w = weight[a:b]
            small = _largest(x) * int(w.sum()) < 2**63
            part = w @ x if small else w.astype(object) @ x.astype(object)
            sums = [s + int(p) for s, p in zip(sums or [0] * len(part), part)]
    if sums:
        yield pa.record_batch([pa.array(range(len(sums)), pa.int32()), _decimals(sums)], ["i", "s"])


def _scatter(sums: list[int], n: int) -> Callable:
    """Per task the upper triangle of the weighted products of centred vectors."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(whole)
        out = np.zeros((d, d))
        for batch in batches:
            weight = batch.column("w").to_numpy().astype(float)
            for a, b, x in _matrices(batch, "x"):
                y = (x - whole).astype(float) - part
                out += (y * weight[a:b, None]).T @ y
        i, j = np.triu_indices(d)
        for at in range(0, len(i), ENTRIES):
            cut = slice(at, at + ENTRIES)
            yield pa.record_batch([pa.array(i[cut], pa.int32()), pa.array(j[cut], pa.int32()), pa.array(out[i[cut], j[cut]])],
                                  ["i", "j", "v"])

    return run


def _project(sums: list[int], n: int, axes: np.ndarray) -> Callable:
    """Each vector's whitened coordinates, and its exact squared distance from the mean times n squared."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in _matrices(batch, "x"):
                y = x - whole
                z = (y.astype(float) - rest / n) @ axes
                if (_largest(y) + 1) ** 2 * n**2 * len(whole) < 2**63:
                    far = ((n * y - rest) ** 2).sum(1).tolist()
                else:
                    far = ((n * y.astype(object) - rest.astype(object)) ** 2).sum(1).tolist()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32()), pa.array(z.ravel()))
                yield pa.record_batch([batch.column("key").slice(a, b - a), batch.column("w").slice(a, b - a), lists, _decimals(far)],
                                      ["key", "w", "z", "far"])

    return run


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100000, by_count: bool = True,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each vector's first ``components`` whitened coordinates, one row per vector and component.

    ``id_col, component, n, deviation, whitened, explained, identity_error``.
    An entry c becomes x = floor(scale * c) + shift. The fit list holds every
    vector (``by_count``) or every distinct one (weight one); n is its length,
    S its sums. ``deviation`` is the exact sum of (n * x - S)^2, a decimal (null
    beyond 38 digits). Axes are unit eigenvectors of the covariance, by falling
    eigenvalue. ``identity_error`` is the largest absolute entry of the fit
    list's covariance of ``whitened`` minus the identity.

    Vectors that are null, hold null or non-finite entries, or entries whose x
    isn't a long, take no part. Shorter vectors count as ending in zeros. Rows
    that repeat an id, or have none, each get their rows. Components without
    variance (beyond rounding; all, if all vectors are equal) have null
    ``whitened``, zero ``explained``, and aren't part of ``identity_error``.
    Vectors without entries and an empty table give no rows. Other columns
    aren't read.

    Vectors cross one shuffle, pre-aggregated, so a vector that a third of the
    rows share is one record a task; the rows come back by the SHA-256 of
    their x, 32 bytes, and the skew join splits those of a common vector. The
    driver holds the covariance, width squared numbers.
    """
    x = F.transform(vector_col, lambda c: F.try_add(F.floor(F.lit(scale) * c.cast("double")), F.lit(shift).cast("long")))
    fits = F.forall(vector_col, lambda c: F.coalesce(F.abs(F.lit(scale) * c.cast("double")) < F.lit(2.0**62), F.lit(False)))
    rows = vectors.filter(F.col(vector_col).isNotNull() & fits).select(F.col(id_col).alias("id"), x.alias("x"))
    width = rows.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x"))))

    def key() -> Column:
        return F.unhex(F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256))

    def result(found: DataFrame, explained: list[float], n: int, error: float) -> DataFrame:
        at = F.posexplode("z").alias("component", "whitened")
        return found.select("id", "far", at).select(
            F.col("id").alias(id_col), (F.col("component") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
            F.col("far").alias("deviation"), "whitened",
            F.element_at(F.array(*map(F.lit, explained or [0.0])), F.col("component") + 1).alias("explained"),
            F.lit(error).alias("identity_error"))

    if not width:
        none = rows.limit(0).select("id", F.lit(None).cast("decimal(38,0)").alias("far"), F.array(F.lit(0.0)).alias("z"))
        return result(none, [], 0, 0.0)

    distinct = staged(rows.groupBy("x").agg(F.count(F.lit(1)).alias("m")).select(
        key().alias("key"), "x", (F.col("m") if by_count else F.lit(1).cast("long")).alias("w")))
    n = distinct.agg(F.sum("w").alias("n")).first()["n"]
    sums = distinct.select("x", "w").mapInArrow(_totals, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    sums = [int(r.s) for r in sums.orderBy("i").collect()]
    cov = np.zeros((width, width))
    products = distinct.select("x", "w").mapInArrow(_scatter(sums, n), "i int, j int, v double")
    for r in products.groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        cov[r.i, r.j] = cov[r.j, r.i] = r.v / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    usable = values > max(float(values[0]), 0.0) * width * 2.0**-52
    axes = np.where(usable, axes / np.sqrt(np.where(usable, values, 1)), 0)
    trace = float(np.trace(cov))
    explained = [float(v) / trace if u else 0.0 for v, u in zip(values, usable)]

    white = staged(distinct.mapInArrow(_project(sums, n, axes), "key binary, w long, z array<double>, far decimal(38,0)"))
    live = [i for i, u in enumerate(usable) if u]
    error = 0.0
    if live:
        means = white.agg(*[(F.sum(F.col("w") * F.col("z")[i]) / n).alias(f"m{i}") for i in live]).first()
        off = {i: F.col("z")[i] - F.lit(means[f"m{i}"]) for i in live}
        pairs = [(i, j) for i in live for j in live if i <= j]
        found = white.agg(*[(F.sum(F.col("w") * off[i] * off[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    z = F.array(*[F.col("z")[i] if i in live else F.lit(None).cast("double") for i in range(len(values))])
    back = rows.select("id", key().alias("key")).join(white.select("key", z.alias("z"), "far"), "key")
    return result(back, explained, n, error)
