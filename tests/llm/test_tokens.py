"""BPE and packing against the tokenizer libraries, chat round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockyard.llm import queries
from dockyard.llm.bpe import decode, encode, vocabulary
from dockyard.llm.chat import CONTROLS, Reader, format_turns, parse_turn, read_back, render_turn
from dockyard.llm.packing import pack_documents, plan
from tests.conftest import SF_SMALL
from tests.llm.tables import SCHEMA

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def strange(spark):
    rng = random.Random(4)
    some = list("ab 's'tre ve'll'd'm  \n\t\r\x0b\x1c\x85\xa0 0129²½ª!?.,-'’“€éßñ") + ["　", " ", "日", "ا", "😀", "ʰ"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    texts += [None, "", " ", "a" * 3000, " " * 2000 + "b", "'" * 700, "it's we'll 's's \n's", "<|endoftext|>", "é" * 900]
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int"), texts


def test_bpe_like_the_library(strange, library):
    df, texts = strange
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in decode(encode(df, MULTI), MULTI).collect()}
    assert got == {i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)}


def test_matrix_and_heap_merge_alike():
    v = vocabulary(MULTI)
    rng = random.Random(1)
    for _ in range(50):
        b = bytes(rng.choice(b"abcdethe  ing") for _ in range(rng.randint(2, 200)))
        out = [()]
        v._merge_bucket([b], [0], out)
        assert out[0] == v._merge_long(b)


def test_op10_digests(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_byte_bpe(spark, SF_SMALL).collect()}
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256((r.text or "").encode()).hexdigest())


def _packed_right(rows, texts, capacity=2048):
    t = Tokenizer.from_file(JSON)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in own:
            assert r.start == at and (r.length == capacity or r.piece == 0)
            crc = r.ids_crc32 if "ids_crc32" in r else zlib.crc32(bytes(r.ids))
            assert crc == zlib.crc32(np.array(ids[at: at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    total = sum(n for s in sequences.values() for _, n in s)
    return len(sequences), -(-total // capacity)


def test_op1(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    used, least = _packed_right(queries.op1_best_fit_packing(spark, SF_SMALL).collect(), texts)
    assert used <= least * 1.02 + 1


def test_packing_odd_texts(spark, strange):
    df, texts = strange
    _packed_right(pack_documents(df, JSON, 64).collect(), dict(enumerate(texts)), 64)
    assert pack_documents(spark.createDataFrame([], SCHEMA), JSON).count() == 0


def test_plan_places_every_piece_once():
    rng = random.Random(3)
    for _ in range(60):
        cap = rng.choice([8, 30, 2048])
        counts = {n: rng.randint(0, 1000) for n in rng.sample(range(1, cap + 1), min(cap, rng.randint(1, 300)))}
        got = {}
        for many, items in plan(counts, cap):
            assert many > 0 and sum(n * t for n, t in items) <= cap
            assert sum(t for n, t in items if 3 * n > cap) <= 2
            for n, t in items:
                got[n] = got.get(n, 0) + many * t
        assert got == {n: c for n, c in counts.items() if c}


def test_turns_round_trip():
    rng = random.Random(6)
    bits = [*CONTROLS, "\\", "<", "s>", "[", "INST]", "ok", " ", "\n", "日", "/"]
    for _ in range(3000):
        role, text = ("".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) for _ in range(2))
        segment, lo, hi = render_turn(role, text)
        assert parse_turn(segment) == (role, text)
        assert not any(c in segment[lo:hi] for c in CONTROLS)


def test_conversations_round_trip():
    rng = random.Random(8)
    bits = [*CONTROLS, "\\", "<", "s>", "[", "[/INST", "]</s>", "ok", " ", "\n", "日", "/"]
    for _ in range(400):
        turns = [tuple("".join(rng.choice(bits) for _ in range(rng.randint(0, 6))) for _ in range(2)) for _ in range(rng.randint(0, 6))]
        text = "".join(render_turn(*t)[0] for t in turns)
        reader, found, at = Reader(), [], 0
        while at < len(text):
            to = at + rng.randint(1, 12)
            found += [(role, said) for role, said, _ in reader.feed(text[at:to])]
            at = to
        reader.close()
        assert found == turns


@pytest.mark.parametrize("text", ["<s>user[INST]a", "x<s>user[INST]a[/INST]</s>", "<s>user[INST]a[/INST]</s> ",
                                  "<s>user[INST]a[INST]b[/INST]</s>", "[/INST]</s>"])
def test_what_is_not_a_conversation(text):
    with pytest.raises(ValueError):
        reader = Reader()
        list(reader.feed(text))
        reader.close()


def test_read_back_finds_what_differs_from_the_source(spark):
    df = format_turns(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")],
                                            "conv_id long, turn long, role string, text string"))
    assert read_back(df).count() == 1
    changed = df.withColumn("segment", F.replace("segment", F.lit("b"), F.lit("c")))
    joined = df.withColumn("segment", F.when(F.col("turn") == 0, F.concat("segment", "segment")).otherwise(F.col("segment")))
    for bad in (changed, joined):
        with pytest.raises(Exception, match="isn't the source's"):
            read_back(bad).collect()


def test_op5(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    own = "</s>[INST] ok [/INST]"
    convs = {-1: [(0, "user", own), (1, "assistant", own)]}
    for r in rows:
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in queries.op5_chat_format(spark, SF_SMALL).collect()}
    assert set(got) == set(convs)
    for i, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        r = got[i]
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(turns), want, len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(render_turn(role, t)[0]) for _, role, t in turns)


def test_chat_nulls_ties_and_empty(spark):
    kind = "conv_id long, turn long, role string, text string, segment string"
    df = spark.createDataFrame([(None, 0, "user", None, "x"), (2, None, None, "a", "x"), (2, 0, "assistant", "b", "x"),
                                (2, 0, "assistant", "b", "x")], kind)
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in read_back(format_turns(df)).collect()}
    assert got == {None: (1, 0), 2: (3, 2)}
    assert read_back(format_turns(spark.createDataFrame([], kind))).count() == 0


def test_added_tokens_like_the_library(spark):
    rng = random.Random(9)
    bits = ["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "\n", "ab", "it's", "日", "12", "é "]
    texts = ["ab <|endoftext|> cd", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b", "plain", "", None]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    t = Tokenizer.from_file(JSON)
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    assert want[0] == [397, 220, 50256, 22927, 0]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in pack_documents(df, JSON).collect()}
    assert got == want
