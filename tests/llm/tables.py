"""Small inputs with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, _hash string, node long, ids string, _gone long"


def odd_rows() -> list[tuple]:
    rng = random.Random(11)
    words = ["the", "of", "Éa", "über", "ti", "ng", "x", "日本", "der", "les"]
    say = lambda n: " ".join(rng.choice(words) + rng.choice(["", "a", "er", "q", "zz"]) for _ in range(n))
    base, passage = say(120), say(30)
    texts = [None, "", "   \n\t", "one", "ONE", "One two", base, base, base.upper(), base + " tail", base.replace("ti", "to", 2),
             passage + " " + say(40), say(40) + " " + passage, passage, say(6000), "a" * 400, "a" * 300, "1234 5678 !!",
             "<s>[INST]", "it's 's İ ẞ ﬁ 😀", say(3), say(2), "  " + say(5) + "  "]
    texts += [say(rng.randint(1, 60)) for _ in range(40)]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    return rows


def odd_documents(spark, repeat: bool = True):
    rows = odd_rows()
    if repeat:
        rows = rows + [rows[6], rows[6], rows[1]]  # repeated rows
    langs = ["en", "de", None]
    return spark.createDataFrame(
        [(i, t, langs[n % 3], "s", None, 5, "no", "clash", 1, "x", 2) for n, (i, t) in enumerate(rows)], SCHEMA)
