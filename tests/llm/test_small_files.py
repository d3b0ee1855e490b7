"""What is written between steps: bands in few bytes, small graphs in few files; what a Python worker keeps."""

import numpy as np
import public_tokenizers
import pytest

from dockyard.llm import components, exact_dedup, lines, lists, minhash, packing, repeats


def test_small_graph_has_one_file_a_table(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "staged", lambda df, f=components.staged: written.append(f(df)) or written[-1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long").repartition(4)
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == dict.fromkeys(range(61), 0) | {100: 100, 101: 100}
    assert all(len(t.inputFiles()) == 1 for t in written)


@pytest.mark.parametrize("run", [exact_dedup.drop_exact, minhash.drop_near, repeats.drop_repeats])
def test_small_tables_have_one_file_whatever_the_shuffle_partitions(spark, monkeypatch, run):
    written = []
    for module in (components, exact_dedup, lists, minhash, repeats):
        monkeypatch.setattr(module, "staged", lambda df, f=module.staged: written.append(f(df)) or written[-1])
    say = lambda a, n: " ".join(f"w{a * i}" for i in range(1, n))
    texts = [say(i + 1, 40) for i in range(40)] + [say(i + 1, 40) + " end" for i in range(20)] + [say(i + 1, 40).upper() for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = {r.doc_id: r.text for r in run(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    if run is repeats.drop_repeats:
        assert len(out) == 80 and all(out[i] == texts[i] for i in (0, 39, 79)) and all(len(out[i]) < 50 for i in range(40, 60))
    else:
        assert len(out) == (60 if run is exact_dedup.drop_exact else 40)
    assert written and max(len(t.inputFiles()) for t in written) == 1


def test_bands_take_six_bytes(spark, monkeypatch):
    written = []
    monkeypatch.setattr(lines, "staged", lambda df, f=lines.staged: written.append(f(df)) or written[-1])
    docs = spark.createDataFrame([(1, "one line of some words\nanother one"), (2, "one line of some words")], "doc_id long, text string")
    assert {(r._id, r.line): r.kept for r in lines.line_groups(docs).collect()} == {(1, 0): True, (1, 1): True, (2, 0): False}
    sizes = [t.selectExpr("max(octet_length(bands)) AS n").first().n for t in written if dict(t.dtypes).get("bands") == "binary"]
    assert sizes == [14 * 6] * 2


def test_packed_bands_are_read_again():
    made = np.random.default_rng(1).integers(-2**63, 2**63, (5, 14))
    high, low = lines._unpacked(lines._packed(made))
    assert (high.astype(np.int64) == (made.ravel() >> 32) % 2**32).all() and (low == (made.ravel() >> 16) % 2**16).all()


def test_a_process_has_one_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing._tokenizer(path) is packing._tokenizer(path)
    assert packing.added_tokens(path) == {"<|endoftext|>": 50256}


def test_lines_of_a_text_are_normal():
    texts = ["a", "", "A b\nc", " a", "a ", "a  B", "a \nb", "a\n b", "a\tb", "É　x\nY", "a \nb", "x\x1cy", "\n\n", "a\x85b\nÀ"]
    for t in texts:
        assert lines.normal_lines(t) == [lines.normal(x) for x in t.split("\n")]
    assert not any(chr(c).isspace() for c in range(0x3001, 0x110000))
