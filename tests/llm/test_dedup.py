"""Exact, near and repeated-string deduplication against plain versions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from dockyard.llm.components import components
from dockyard.llm.exact_dedup import drop_exact, exact_groups
from dockyard.llm.minhash import drop_near, near_groups
from dockyard.llm.repeats import drop_repeats, remove_repeats
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.tables import SCHEMA, odd_documents, odd_rows


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups(spark, odd, keep):
    rows = [(r.doc_id, brute.lower(r.text or "")) for r in odd.collect()]
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, []).append(i)
    best = max if keep == "max" else min
    want = sorted((i, best(by_text[t]), len(by_text[t]), i == best(by_text[t]), hashlib.sha256(t).hexdigest()) for i, t in rows)
    assert sorted(map(tuple, exact_groups(odd, keep=keep).collect())) == want


def test_drop_exact_keeps_one_row_of_each_text_and_all_columns(spark, odd):
    out = drop_exact(odd)
    assert out.columns == odd.columns
    texts = [brute.lower(r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {brute.lower(r.text or "") for r in odd.collect()}


def test_exact_groups_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "A"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = {(r.doc_id, r.group_size, r.keep_id, r.kept) for r in exact_groups(df).collect()}
    assert got == {(None, 3, 3, False), (3, 3, 3, True), (None, 1, None, True)}


@pytest.mark.parametrize("words", [1, 2, 5])
def test_near_groups_odd_texts(spark, words):
    rows = odd_rows()
    df = odd_documents(spark)
    want = brute.near_components(rows, words, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(df, words, 80, list_size=3).collect()}
    assert got == want
    assert near_groups(df, words, 80).count() == df.count()


@pytest.mark.parametrize("words", [2, 5])
def test_near_groups_documents(spark, words):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute.near_components([(r.doc_id, r.text) for r in df.collect()], words, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(df, words, 80).collect()} == want


def test_near_groups_long_lists_are_whole(spark):
    """Documents made of one passage that all share, some near copies of each other, some not."""
    import random
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = [f"w{rng.randint(0, 40)}" for _ in range(rng.choice([4, 10, 25]))]
        rows.append((i, " ".join(passage + own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_components(rows, 2, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(df, 2, 80, list_size=4).collect()}
    assert got == want and len({c for _, c in want.values()}) > 20


def test_drop_near(spark, odd):
    out = drop_near(odd, words=2)
    assert out.columns == odd.columns
    comp = brute.near_components(odd_rows(), 2, 80)
    assert {r.doc_id for r in out.collect()} == {i for i, (_, c) in comp.items() if i == c}


def test_remove_repeats_odd_texts(spark):
    rows = odd_rows()
    df = odd_documents(spark, repeat=False)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df).collect()}
    assert got == brute.repeated_bytes(rows)


@pytest.mark.parametrize("length,gram", [(50, 22), (50, 16), (12, 5)])
def test_remove_repeats_documents(spark, length, gram):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(F.length("text") < 20000)
    want = brute.repeated_bytes([(r.doc_id, r.text) for r in df.collect()], length)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, length, gram).collect()}
    assert got == want


def test_drop_repeats_keeps_rows_and_columns(spark, odd):
    out = drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for df in (exact_groups(none), drop_exact(none), near_groups(none), drop_near(none), remove_repeats(none), drop_repeats(none)):
        assert df.count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.components({x for e in edges if e[0] != e[1] for x in e}, edges[:-1])
    assert got == want
