"""Inputs that earlier versions got wrong: words made to share a hash, tasks of short texts alone, ids that repeat."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

from dockyard.llm.bpe import decode, encode
from dockyard.llm.html_text import main_text
from dockyard.llm.langid import fit, identify
from dockyard.llm.minhash import near_groups
from dockyard.llm.packing import pieces_of
from dockyard.llm.repeats import drop_repeats, remove_repeats
from tests.llm import brute


def twins(n: int = 1024) -> tuple[str, str]:
    """Two different words of one polynomial hash modulo 2**64, whatever the odd base (Thue-Morse order)."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(scope="module")
def twin_docs(spark):
    a, b = twins()
    return spark.createDataFrame([(1, a), (2, b), (3, f"{b} x {a}")], "doc_id long, text string").coalesce(1)


def test_words_of_one_hash_get_their_own_ids(spark, twin_docs):
    texts = {r.doc_id: r.text for r in twin_docs.collect()}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in decode(encode(twin_docs, path), path).collect()}
    assert {i: d for i, (_, d) in got.items()} == {i: t.encode() for i, t in texts.items()}
    ranks = load_tiktoken_bpe(path)
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: x for i, (x, _) in got.items()} == {i: enc.encode_ordinary(t) for i, t in texts.items()}
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for r in pieces_of(twin_docs, path, 1 << 20).collect():
        assert np.frombuffer(bytes(r.ids), np.uint32).tolist() == [*library.encode(texts[r._id], add_special_tokens=False).ids, 0]


def test_words_of_one_hash_are_not_near(twin_docs):
    assert all(r.doc_id == r.component_id for r in near_groups(twin_docs, 2, 80).collect())


@pytest.mark.parametrize("rows", [[(1, "short")], [(1, None)], [(1, "a"), (2, "a"), (3, "")]])
def test_repeats_in_short_texts_alone(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in remove_repeats(df).collect()} == {
        i: (len(t or ""), 0, (t or "").encode()) for i, t in rows}
    assert sorted(map(tuple, drop_repeats(df).collect()), key=str) == sorted(rows, key=str)


def test_repeats_where_ids_repeat(spark):
    """Rows of one id have their own offsets, and never remove each other."""
    passage = "the quick brown fox jumps over the lazy dog and then it runs away again "
    rows = [(1, "a" * 30 + passage + "b" * 700), (2, passage), (2, "z" * 300 + passage[:60] + "y" * 5), (2, "other text"),
            (5, "c" * 20 + passage[5:] + "d" * 60), (5, "e" * 60 + passage[:55]), (5, "q" * 70), (6, "q" * 70), (7, "e" * 55)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = []
    for n, (i, t) in enumerate(rows):
        # each row against all rows of smaller ids
        others = [(j, u) for j, u in rows if j < i]
        one = brute.repeated_bytes([*[(k, u) for k, (_, u) in enumerate(others)], (len(others), t)])[len(others)]
        alone = _own(t, [u for _, u in others])
        want.append((i, len(t), alone.count(True), bytes(b for b, g in zip(t.encode(), alone) if not g)))
        assert one[0] == len(t)
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in remove_repeats(df).collect()]
    assert sorted(got) == sorted(want)


def _own(text: str, others: list[str], length: int = 50) -> list[bool]:
    b, gone = text.encode(), [False] * len(text.encode())
    for p in range(len(b) - length + 1):
        if any(b[p: p + length] in u.encode() for u in others):
            gone[p: p + length] = [True] * length
    return gone


LONG = "This paragraph of the article has more than enough words to be told from the links and buttons around it by anyone who reads on."


def test_an_article_inside_a_form():
    for around, inner in (("form id=f", "article"), ("fieldset", "main"), ("div role=form", "article"), ("aside", "main"), ("dialog open", "main")):
        tag = around.split()[0]
        page = f"<body><nav><a href=/>x</a></nav><{around}><label>Name</label><{inner}><h1>T</h1><p>{LONG}</p><p>Short.</p></{inner}><label>Mail</label></{tag}></body>"
        assert main_text(page).split("\n") == ["T", LONG, "Short."], around
    teaser = f"<body><article><h1>T</h1><p>{LONG}</p></article><aside><article><p>{LONG}</p></article></aside><form><p>{LONG}</p></form></body>"
    assert main_text(teaser).split("\n") == ["T", LONG]


def test_signs_that_are_no_letters(spark):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["the cat and the dog", "der Hund und die Katze"] * 6)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, "½ ² ①"), (2, "42 – 7"), (3, "½ der"), (4, "ª")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in identify(df, model).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_language_by_a_plain_nearest_centroid(spark):
    """Predictions and scores against a slow version of the vectors and the cosine."""
    import math
    from collections import Counter
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs)
    from dockyard.llm.rolling import mix

    def fold(t):
        return bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or chr(x).isalpha() else 32 for x in f" {t} ".encode())

    def plain(t):
        b, c = fold(t), Counter()
        for n in model.sizes:
            for p in range(len(b) - n + 1):
                gram = b[p: p + n]
                if gram.strip(b" "):
                    c[int(mix(np.array([int.from_bytes(gram, "big")], np.uint64))[0]) % len(model.idf)] += 1
        v = {k: math.log1p(x) * model.idf[k] for k, x in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        sims = [sum(x / norm * float(p[k]) for k, x in v.items()) for p in model.points]
        best = max(range(len(sims)), key=lambda i: sims[i])
        return model.langs[best], sims

    some = [r for r in docs.orderBy("doc_id").limit(25).collect() if r.text and len(r.text) < 3000]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(some, docs.schema), model).collect()}
    for r in some:
        if got[r.doc_id].lang_pred != "und":
            lang, sims = plain(r.text)
            assert abs(got[r.doc_id].score - min(1, max(0, max(sims)))) < 1e-4
            assert got[r.doc_id].lang_pred == lang or sorted(sims)[-1] - sorted(sims)[-2] < 1e-4
