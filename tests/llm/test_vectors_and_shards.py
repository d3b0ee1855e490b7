"""Sharding, hard-negative mining and whitening against plain versions."""

import math
import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dockyard.llm import queries
from dockyard.llm.negatives import bit_planes, mine, scores
from dockyard.llm.sharding import fisher_yates, shard, write_shards
from dockyard.llm.whitening import whiten
from tests.conftest import SF_SMALL
from tests.llm.tables import odd_documents

KIND = "vec_id long, embedding array<float>, label int, id long, x string, w int, `key` string, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2, "k", 3) for i, v, label in rows], KIND)


def odd_vectors(seed: int = 3, n: int = 160):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.003, 1.25]) for _ in range(rng.choice([9, 10]))], rng.choice([0, 1, 2])) for i in range(n)]
    same = [0.5] * 10
    rows += [(1000 + i, same, i % 2) for i in range(80)]  # a common vector
    rows += [(2000, None, 1), (2001, [None, 1.0], 1), (2002, [float("nan")], 1), (2003, [float("-inf"), 1.0], 1),
             (2004, [], 1), (2100, [0.5], None), (None, [1.0, 2.0], 1), (3, [1.0, 1.0, 1.0], 2), (1000, same, 0), (100, same, 1)]
    return rows


# sharding

def check_law(rows, shards):
    """Slots are gapless from 0 and shards differ by one row at most."""
    slots = defaultdict(list)
    for s, slot in rows:
        slots[s].append(slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1


def test_op11_rows_and_law(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op11_sharding(spark, SF_SMALL).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs.items()}
    assert len(got) == len(docs) and {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    check_law([(r.shard, r.slot) for r in got], 8)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, queries.op11_sharding(spark, SF_SMALL).collect()), key=str)


def test_shard_keeps_every_row_and_column(spark):
    folder = tempfile.mkdtemp(prefix="shards-")
    odd_documents(spark).withColumnRenamed("_hash", "_place").withColumnRenamed("_id", "_bucket").write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    for shards, size in ((8, 1 << 25), (3, 200), (500, 1 << 25)):
        placed = shard(docs, shards=shards, seed=5, bucket_bytes=size)
        assert placed.columns == [*docs.columns, "shard", "slot"]
        rows = placed.collect()
        assert Counter(tuple(r)[:-2] for r in rows) == Counter(map(tuple, docs.collect()))
        check_law([(r.shard, r.slot) for r in rows], shards)
    order = {seed: [(r.shard, r.slot) for r in sorted(shard(docs, seed=seed).collect(), key=str)] for seed in (1, 2, -1)}
    assert len({str(x) for x in order.values()}) == 3
    again = shard(shard(docs).write.parquet(f"{folder}/once") or spark.read.parquet(f"{folder}/once"), shards=2)
    assert again.columns == [*docs.columns, "shard", "slot"] and again.count() == docs.count()
    write_shards(shard(docs, shards=3), f"{folder}/out")
    back = spark.read.parquet(f"{folder}/out")
    assert Counter(tuple(r)[:-2] for r in back.select(*docs.columns, "slot", "shard").collect()) == Counter(map(tuple, docs.collect()))
    assert shard(docs.limit(0)).count() == 0


def test_order_is_uniform(spark):
    rng = np.random.default_rng(1)
    seen = Counter(tuple(fisher_yates(4, rng)) for _ in range(24000))
    assert len(seen) == 24 and sum((n - 1000) ** 2 / 1000 for n in seen.values()) < 60
    assert list(fisher_yates(0, rng)) == [] and list(fisher_yates(1, rng)) == [0]
    folder = tempfile.mkdtemp(prefix="shards-") + "/docs"
    spark.range(4000).selectExpr("7 AS doc_id", "'same' AS text", "id").write.parquet(folder)  # one id and one text
    cells = Counter((r.id // 1000, r.shard) for r in shard(spark.read.parquet(folder), shards=4).collect())
    assert sum((cells[a, b] - 250) ** 2 / 250 for a in range(4) for b in range(4)) < 35  # 9 degrees of freedom


# hard negatives

def plain_negatives(rows, anchors, positives, negatives, low, high):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if i is not None and label is not None
            and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, label in good:
        if anchors(i):
            first[i] = min(first.get(i, (label, v)), (label, v))
    out = Counter()
    for a, (label, av) in first.items():
        found = sorted((-sum(p * q for p, q in zip(av, v)), i, its == label) for i, v, its in good if i != a)
        for s, p, _ in [x for x in found if x[2]][:positives]:
            window = [x for x in found if not x[2] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out.update((a, p, n, i, -s, -x) for n, (x, i, _) in enumerate(window, 1))
    return out


def test_scores_of_any_size():
    rng = np.random.default_rng(2)
    for most, d in ((1, 1), (2, 17), (300, 64), (2**20, 9), (2**40, 8), (2**61, 3)):
        rows, anchors = rng.integers(-most, most, (70, d)), rng.integers(-most, most, (67, d + 2))
        want = rows.astype(object) @ anchors[:, :d].T.astype(object)
        assert (scores(bit_planes(rows), anchors).astype(object) == want).all()
    assert (scores(bit_planes(np.array([[-(2**62), 2**62 - 1]])), np.array([[1, 1]])) == -1).all()
    assert scores(bit_planes(np.zeros((2, 0), np.int64)), np.ones((3, 4), np.int64)).tolist() == [[0] * 3] * 2


def test_negatives_of_odd_vectors(spark):
    rows = odd_vectors()
    df = vectors(spark, rows)
    for size, block, k in ((16, 2, 5), (4096, 512, 50)):
        got = mine(df, df.filter("vec_id % 20 = 0"), positives=k, pack_rows=size, block_rows=block)
        assert Counter(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
                           .collect())) == plain_negatives(rows, lambda i: i % 20 == 0, k, 10, 30, 90)
    assert mine(df.limit(0), df.limit(0)).count() == 0 and mine(df, df.limit(0)).count() == 0
    alone = df.filter("label = 1")
    assert mine(alone, alone).count() == 0


def test_negatives_beyond_a_long(spark):
    """Scores are 64 * 10^18 * 256^2 and the like: both saturate; 3e300 has no long."""
    df = spark.createDataFrame([(0, [1e16, 0.0], 1), (1, [5e15, 0.0], 1), (2, [2e15, 0.0], 2), (3, [3e300, 0.0], 2), (4, [8e-3, 1.0], 2)],
                               "vec_id long, embedding array<double>, label int")
    most = 2**63 - 1
    got = mine(df, df.filter("vec_id = 0"), low=0, high=100).collect()
    assert [(r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got] == [
        (1, 1, 2, most, most), (1, 2, 4, most, 2 * 256 * 10**16)]


# whitening

def plain_whitening(rows, components, by_count=True):
    good = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in good)
    xs = [(i, tuple(math.floor(1024 * c) + 100000 for c in v) + (100000,) * (width - len(v))) for i, v in good]
    fit = [x for _, x in xs] if by_count else sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) for c, s in zip(x, sums)] for x in fit], float) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in xs:
        off = [n * c - s for c, s in zip(x, sums)]
        out.setdefault((i, x), (sum(o * o for o in off), (np.array(off, float) / n) @ axes[:, :components] / np.sqrt(values[:components])))
    return xs, n, out, values / values.sum()


@pytest.mark.parametrize("by_count", [True, False])
def test_whitening_of_odd_vectors(spark, by_count):
    rows = odd_vectors()
    xs, n, want, explained = plain_whitening(rows, 8, by_count)
    got = whiten(vectors(spark, rows), by_count=by_count).collect()
    assert len(got) == 8 * len(xs) and {r.n for r in got} == {n}
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == Counter({k: 8 * c for k, c in Counter((i, want[i, x][0]) for i, x in xs).items()})
    signs = {}
    near = defaultdict(list)
    for (i, _), (_, z) in want.items():
        near[i].append(z)
    for r in got:
        assert abs(r.explained - explained[r.component - 1]) <= 1e-9
        # one sign a component for all rows
        ok = {s for s in (1, -1) if any(abs(s * r.whitened - z[r.component - 1]) < 1e-8 for z in near[r.vec_id])}
        signs[r.component] = signs.get(r.component, {1, -1}) & ok
    assert all(signs[c] for c in range(1, 9)) and {r.identity_error < 1e-9 for r in got} == {True}


def test_op13_identity(spark):
    got = queries.op13_whitening(spark, SF_SMALL).collect()
    n = got[0].n
    z = defaultdict(dict)
    for r in got:
        z[r.vec_id][r.component] = r.whitened
    m = np.array([[row[c] for c in range(1, 9)] for row in z.values()])
    assert len(m) == n == len(got) // 8
    assert abs(m.T @ m / n - np.eye(8)).max() < 1e-9 and abs(m.mean(0)).max() < 1e-9
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    xs, _, want, _ = plain_whitening(rows, 8)
    assert {r.vec_id: r.deviation for r in got} == {i: want[i, x][0] for i, x in xs}


def test_whitening_without_variance(spark):
    kind = "vec_id long, embedding array<double>"
    flat = whiten(spark.createDataFrame([(i, [0.5, 0.25]) for i in range(4)], kind)).collect()
    assert len(flat) == 8 and all(r.whitened is None and r.explained == 0 and r.identity_error == 0 and r.deviation == 0 for r in flat)
    line = whiten(spark.createDataFrame([(i, [float(i % 3), 0.25]) for i in range(6)], kind)).collect()
    assert {r.component for r in line if r.whitened is not None} == {1} and len(line) == 12
    assert whiten(spark.createDataFrame([], kind)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, []), (3, [float("inf")])], kind)).count() == 0
    one = whiten(spark.createDataFrame([(None, [1.0] * 9)], kind)).collect()
    assert [(r.vec_id, r.n, r.whitened) for r in one] == [(None, 1, None)] * 8
    far = whiten(spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 3.0]), (3, [0.5, 1e300])], kind)).collect()
    assert {r.vec_id for r in far} == {1, 2} and {r.deviation for r in far} == {
        (1024 * 10**12 * 2) ** 2 + 3072**2}
