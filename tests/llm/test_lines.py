"""Fuzzy line deduplication against a plain version."""

import random

from dockyard.llm.lines import drop_lines, normal, shingle_sets
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.tables import SCHEMA, odd_documents, odd_rows


def plain(rows, shingle=8, percent=80):
    """doc_id -> (lines, removed, text); every pair of different lines that share a shingle is compared."""
    first, sets = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for j, line in enumerate((t or "").split("\n")):
            n = normal(line)
            if n:
                first.setdefault(n, (i, j))
                sets.setdefault(n, {n[k: k + shingle] for k in range(max(1, len(n) - shingle + 1))})
    lists = {}
    for n, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(n)
    links = {(a, b) for l in lists.values() for a in l for b in l if a < b
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    index = {n: k for k, n in enumerate(sorted(first, key=first.get))}
    comp = brute.components(index.values(), [(index[a], index[b]) for a, b in links])
    stays = {first[n] for n in first if comp[index[n]] == index[n]}
    out = {}
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for j, x in enumerate(lines) if not normal(x) or (i, j) in stays]
        out[i] = (len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept))
    return out


def rows_with_lines():
    rng = random.Random(9)
    lines = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "éps", "zeta"]) + str(rng.randint(0, 99)) for _ in range(20)) for _ in range(25)]
    rows = []
    for i in range(60):
        some = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(lines)
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice(["", "X", "  "]) + line[at + 1:]
            some.append(line if rng.random() < 0.8 else "")
        rows.append((i * 13 % 60, "\n".join(some)))
    return rows


def test_near_lines(spark):
    rows = rows_with_lines()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for how in ({}, {"list_size": 2}):
        got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in drop_lines(df, **how).collect()}
        assert got == plain(rows)


def test_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in df.collect()])
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in drop_lines(df).collect()}
    assert sum(got[i] == w for i, w in want.items()) >= 0.99 * len(want)
    assert sum(w[1] for w in want.values()) > 0


def test_odd_texts(spark):
    rows = odd_rows()
    df = odd_documents(spark, repeat=False)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in drop_lines(df).collect()} == plain(rows)
    assert drop_lines(odd_documents(spark)).count() == df.count() + 3
    assert drop_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingle_sets():
    lines = ["", "ab", "abcdefgh", "abcdefghi", "aaaaaaaaaaaa"]
    _, n = shingle_sets(lines, 8)
    assert n.tolist() == [0, 1, 1, 2, 1]
