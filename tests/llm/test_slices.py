"""Texts are taken from a batch in small parts, so that a task holds few of them as Python objects."""

import random

import pyarrow as pa

from dockyard.llm import repeats
from dockyard.llm.tables import slices
from tests.llm import brute


def test_batches_are_cut_and_nothing_is_lost():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (0, 2500, 1)]
    parts = list(slices(iter(batches)))
    assert [len(p) for p in parts] == [1024, 1024, 452, 1]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(2500), 0]


def test_op7_repeats_across_parts_of_a_batch(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    passages = [" ".join(word() for _ in range(9)) for _ in range(6)]
    rows = [(i, " ".join([word(), rng.choice(passages), word()]) if i % 4 == 0 else word()) for i in range(2300)]
    got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    gone = brute.repeated_bytes(rows)
    assert got == {i: gone[i][3] for i, _ in rows}


def test_op7_flush_holds_a_quarter_million_records():
    assert repeats._FLUSH <= 1 << 18 and repeats._BLOCK <= 1 << 18
