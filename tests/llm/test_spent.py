"""What near-dedup keeps on disk: tables that nothing reads any more go, blocks are cut by what they hold."""

import os

import pyarrow.parquet as pq

from dockyard.llm import lists, minhash
from dockyard.llm.tables import shared_dir


def _tables(spark):
    top = shared_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(top) if x.startswith("llm-")}


def _docs(spark):
    say = lambda a, n: " ".join(f"w{a * i}" for i in range(1, n))
    texts = [say(i + 1, 60) for i in range(30)] + [say(i + 1, 60) + " end" for i in range(30)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_f1_sketches_and_full_sets_are_deleted_once_they_are_read(spark):
    before = _tables(spark)
    got = {r.doc_id: r.component_id for r in minhash.near_groups(_docs(spark)).collect()}
    assert got == {i: i % 30 for i in range(60)}
    left = _tables(spark) - before
    top = shared_dir(spark).removeprefix("file:")
    names = {c for x in left for f in os.listdir(f"{top}/{x}") if f.endswith(".parquet") for c in pq.read_schema(f"{top}/{x}/{f}").names}
    assert left and not names & {"_sketch", "_full"}


def test_f1_blocks_hold_as_many_values_as_fit(spark, monkeypatch):
    full = spark.createDataFrame([(i, [1, 2, 3, 100 + i, -1 - i // 2]) for i in range(300)], "node long, _full array<long>")
    want = spark.createDataFrame([(i, 0) for i in range(1, 300)], "d long, g long")
    groups = spark.createDataFrame([], "node long, component long")
    cuts = []
    monkeypatch.setattr(lists, "staged", lambda df, f=lists.staged: cuts.append(f(df)) or cuts[-1])

    def links(values):
        monkeypatch.setattr(lists, "VALUES", values)
        return {(r.a, r.b) for r in lists._against(want, groups, lambda need: full.join(need, "node", "left_semi"), 60, lists._flat).collect()}

    assert links(1 << 19) == {(2 * i, 2 * i + 1) for i in range(150)}
    assert [(r.nb, r.nc) for t in cuts if "nb" in t.columns for r in t.collect()] == [(1, 1)]
    cuts.clear()
    assert links(300) == {(2 * i, 2 * i + 1) for i in range(150)}
    assert [(r.nb, r.nc) for t in cuts if "nb" in t.columns for r in t.collect()] == [(5, 5)]
