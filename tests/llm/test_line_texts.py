"""Candidate lines are compared from their texts; documents and shingles stay where they are read."""

import numpy as np
import pyarrow as pa

from dockyard.llm import lines


def test_op6_pairs_of_texts_against_plain_sets(spark):
    texts = ["short", "shorT", "a line of some length, number 1", "a line of some length, number 12", "a" * 40, "a" * 60, "éé日本語 text with signs"]
    plain = [{t[k: k + 8] for k in range(max(1, len(t) - 7))} for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(len(texts))]
    met = spark.createDataFrame([(i, j, texts[i], texts[j]) for i, j in pairs], "a long, b long, _fa string, _fb string")
    got = {(r.a, r.b) for r in lines.alike_lines(met, 80, 8).collect()}
    assert got == {(i, j) for i, j in pairs if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])}
    assert len(got) > len(texts)


def test_op6_filter_has_every_place_asked_for(spark):
    want = [(None, 3), (7, 0), (-1, 9), (2**40, 5)]
    bits = lines._place_filter(spark.createDataFrame(want, "_id long, line int"))
    at = lines._places(pa.array([i for i, _ in want], pa.int64()), np.array([n for _, n in want]))
    assert (((bits[at // 64] >> (at % 64)) & 1) == 1).all()
    assert sum(int(w).bit_count() for w in bits.view(np.uint64)) == len(want)
