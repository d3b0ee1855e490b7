"""Language identification by nearest centroid over TF-IDF vectors of hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.rolling import mix

_LETTER = regex.compile(r"\p{L}")
#: Rows of a batch that are Python texts at once.
_ROWS = 256


def _fold() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for b in range(128):
        if not chr(b).isalpha():
            t[b] = 32
    return t


_FOLD = _fold()


def counts(texts: Sequence[str], dim: int, sizes: Sequence[int]) -> np.ndarray:
    """Counts of hashed n-grams, one row a text. Bytes other than letters count as blanks; blanks alone don't."""
    raw = [b" " + t.encode() + b" " for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    b = _FOLD[np.frombuffer(b"".join(raw), np.uint8)]
    row = np.repeat(np.arange(len(raw), dtype=np.int64) * dim, lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    out = np.zeros(len(raw) * dim, np.int64)
    code = np.zeros(len(b), np.uint64)
    for n in range(1, max(sizes) + 1):
        code = (code[: len(b) - n + 1] << np.uint64(8)) | b[n - 1:]
        if n not in sizes or not len(code):
            continue
        blank = sum(32 << (8 * i) for i in range(n))
        at = np.arange(len(code))
        good = (at + n <= ends[: len(code)]) & (code != blank)
        # three bytes at most: the bucket of a code is looked up
        bucket = _buckets(n, dim)[code[good].astype(np.int64)] if n <= 2 else (
            mix(code[good]) % np.uint64(dim)).astype(np.int64)
        out += np.bincount(row[: len(code)][good] + bucket, minlength=len(out))
    return out.reshape(len(raw), dim)


def _buckets(n: int, dim: int) -> np.ndarray:
    return (mix(np.arange(1 << 8 * n, dtype=np.uint64)) % np.uint64(dim)).astype(np.int64)


def vectors(texts: Sequence[str], idf: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Unit vectors of (1 + log count) * idf; zero rows where a text has no n-gram."""
    c = counts(texts, len(idf), sizes).astype(np.float32)
    np.log1p(c, out=c)
    c *= idf
    norm = np.sqrt((c * c).sum(axis=1, keepdims=True))
    return c / np.where(norm > 0, norm, 1)


def _chunks(texts: Sequence[str], size: int = 1 << 17, rows: int = 64) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size or i + 1 - at >= rows:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of ``k`` clusters by cosine; starts from rows far from each other."""
    picked = [int((x @ x.mean(axis=0)).argmax())]
    near = x @ x[picked[0]]
    while len(picked) < min(k, len(x)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


class Model:
    """``langs[i]`` is the language of ``points[i]``; ``floor`` has the least similarity accepted for it."""

    def __init__(self, langs: list[str], points: np.ndarray, floors: np.ndarray, idf: np.ndarray, sizes: Sequence[int]):
        self.langs, self.points, self.floors, self.idf, self.sizes = langs, points, floors, idf, tuple(sizes)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, similarity, rejected) of each text."""
        langs, scores, rejected = [], [], []
        texts = [t if t is not None and _LETTER.search(t) else "" for t in texts]
        for a, b in _chunks(texts):
            sim = vectors(texts[a:b], self.idf, self.sizes) @ self.points.T
            best = sim.argmax(axis=1) if len(self.langs) else np.zeros(b - a, int)
            for t, i, s in zip(texts[a:b], best.tolist(), sim):
                known = bool(t) and bool(self.langs)
                langs.append(self.langs[i] if known else "und")
                scores.append(min(1.0, max(0.0, float(s[i]))) if known else 0.0)
                rejected.append(not known or scores[-1] < self.floors[i])
        return langs, np.array(scores), np.array(rejected, bool)


def held_out(id_col: str = "doc_id"):
    """Rows of the test fold: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(train: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", dim: int = 4096,
        sizes: Sequence[int] = (1, 2, 3), clusters: int = 4, sample: int = 240, slack: float = 0.5, low: float = 0.02) -> Model:
    """A model of the rows of ``train`` with a language and a text that holds a letter.

    Document frequencies come from all rows. The centroids of a language come
    from ``clusters`` clusters of a sample of about ``sample`` of its rows,
    chosen by a hash of id and text. A text is rejected when its similarity to
    the nearest centroid is below ``slack`` times the ``low`` quantile of the
    similarities of that language's sample, so that a few mislabelled rows
    can't set it (below 51 rows it is the least one). The model's size depends
    on ``dim``, ``clusters`` and the number of languages only. With no rows,
    every text is rejected.
    """
    spark = train.sparkSession
    rows = train.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))

    def frequency(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(dim, np.int64), 0
        for part in parts:
            texts = part["text"].tolist()
            for a, b in _chunks(texts):
                total += (counts(texts[a:b], dim, sizes) > 0).sum(axis=0)
            n += len(texts)
        yield pd.DataFrame({"bucket": np.arange(-1, dim), "n": np.concatenate([[n], total])})

    df = np.zeros(dim + 1)
    for r in rows.select("text").mapInPandas(frequency, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"] + 1] = r["n"]
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)

    per = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), sample / F.col("n"))
    chance = F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    # one row a language: bounded by the number of languages
    some = rows.join(F.broadcast(per), "lang").filter(chance < share).select("lang", "text")

    def cluster(key, group: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(group["text"])
        x = np.concatenate([vectors(texts[a:b], idf, sizes) for a, b in _chunks(texts)])
        c = centroids(x, clusters)
        floor = slack * np.quantile((x @ c.T).max(axis=1), low, method="lower")
        return pd.DataFrame({"lang": key[0], "floor": float(floor),
                             "point": [p.astype(np.float32).tobytes() for p in c]})

    made = some.groupBy("lang").applyInPandas(cluster, "lang string, floor double, point binary").collect()
    made.sort(key=lambda r: (r["lang"], r["point"]))
    points = np.array([np.frombuffer(r["point"], np.float32) for r in made], np.float32).reshape(-1, dim)
    return Model([r["lang"] for r in made], points, np.array([r["floor"] for r in made]), idf, sizes)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``, from the text alone.

    A null text, and one without a letter, is ``und`` with score 0 and is
    rejected. Each row is handled by itself and in whole; nothing is shuffled.
    Columns of ``docs`` with these three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    kinds = docs.schema
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
    out = StructType([*(kinds[c] for c in keep), StructField("lang_pred", StringType()),
                      StructField("score", DoubleType()), StructField("rejected", BooleanType())])

    def run(batches):
        import pyarrow as pa
        for part in (b.slice(at, _ROWS) for b in batches for at in range(0, len(b), _ROWS)):
            langs, scores, rejected = shared.value.predict(part.column(keep.index(text_col)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"])

    return docs.select(*keep).mapInArrow(run, out)


def drop_rejected(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a model of ``docs`` itself rejects; all columns stay."""
    model = fit(docs.filter(~held_out(id_col)), lang_col, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for part in (b.slice(i, _ROWS) for b in batches for i in range(0, len(b), _ROWS)):
            keep = ~shared.value.predict(part.column(at).to_pylist())[2]
            yield part if keep.all() else part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
