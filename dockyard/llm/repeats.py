"""Removal of byte strings that repeat across documents.

A string of ``length`` bytes is dropped where it also starts in a document
with a smaller id. Sorting all suffixes of a corpus moves many times its size,
so the suffixes that meet in a shuffle are chosen by content: of every window
of ``length`` bytes, the gram with the least hash is its anchor. Neighbouring
windows share their anchor, and such a run of windows is compared as one
string, by its prefix polynomial hash. Equal runs settle all their windows.
Runs that share only their anchor's gram and some bytes around it with another
document (at the ends of a repeated passage) are compared window by window. Every sort
is of hash-compared suffixes cut at the length that matters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.rolling import BASES, Rolling, ragged, sliding_min
from dockyard.llm.tables import fresh, in_files, release, slices, staged, tasks

_POSITION = np.uint64((1 << 26) - 1)
_BLOCK = 1 << 18  # bytes hashed at once, so that the arrays stay in the processor's cache
_FLUSH = 1 << 18  # records sorted at once inside a task
_BUCKETS = 4  # groups of records per shuffle partition; each task writes a row for each group it has records of
_BYTES = 1 << 23  # bytes of text whose spans one task writes, at least

SPAN, RUN = 0, 1


def _blocks(raw: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, b in enumerate(raw):
        total += len(b)
        if total >= _BLOCK:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(raw):
        yield at, len(raw)


def anchored_runs(raw: Sequence[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one anchor: document, first start, last start, anchor, the hashes of its gram
    and of the whole run, and of the gram with as many bytes before and after it as any window of its first
    or second half holds (0 where the run has no window of that half).

    The anchor is the leftmost gram with the least hash in the window, so it
    depends on the window's bytes alone. A text longer than 2**26 bytes is cut
    into parts that overlap by a window less a byte; no window is lost.
    """
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = []
    part = int(_POSITION) - length
    for at in range(0, max(1, len(data) - length + 1), part):
        b = data[at: at + part + length - 1]
        r = Rolling(b)
        g = r.fixed(gram)
        if len(b) < length:
            continue
        v = (g & ~_POSITION) | np.arange(len(g), dtype=np.uint64)
        anchor = (sliding_min(v, length - gram + 1) & _POSITION).astype(np.int64)
        start = np.arange(len(anchor)) + at
        doc = np.searchsorted(ends, start, "right")
        good = start + length <= ends[np.minimum(doc, len(ends) - 1)]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~good[:-1]
        first = np.flatnonzero(good & change)
        last = np.flatnonzero(good & np.append(change[1:] | ~good[1:], True))
        d = doc[first]
        base = ends[d] - sizes[d] - at
        a, half = anchor[first], (length - gram) // 2
        before = np.where(first <= a - half, r.of(np.maximum(a - half, 0), a + gram), 0)
        after = np.where(last > a - half, r.of(a, np.minimum(a + gram + half, len(b))), 0)
        out.append((d, first - base, last - base, a - base, g[a], r.of(first, last + length), before, after))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 4)
    return tuple(np.concatenate(c) for c in zip(*out))


def _merged(doc: np.ndarray, v: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of a text (document and variant) as one; those of one text start and end in the same order."""
    if not len(doc):
        return doc, v, start, end
    o = np.lexsort((end, start, v, doc))
    doc, v, start, end = doc[o], v[o], start[o], end[o]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (v[1:] != v[:-1]) | (start[1:] > end[:-1])
    at = np.flatnonzero(new)
    return doc[at], v[at], start[at], np.maximum.reduceat(end, at)


def _smallest(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by keys then document, group of each in that order, True where its document is not its group's smallest)."""
    o = np.lexsort((doc, *keys[::-1]))
    new = np.ones(len(o), bool)
    new[1:] = False
    for k in keys:
        s = k[o]
        new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    d = doc[o]
    return o, group, d != d[np.flatnonzero(new)][group]


def _shared(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where the key is in several documents."""
    distinct, of = np.unique(key, return_inverse=True)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    high = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, of, doc)
    np.maximum.at(high, of, doc)
    return (low < high)[of]


_BLOBS = "bucket long, kind int, n long, doc binary, v binary, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_CELLS = ("doc", "v", "a", "b", "c", "d", "e", "f", "g")
_SPANS = "_id long, _v long, kind int, s int, e int"


def _blob_rows(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """The columns cut by bucket, each piece as bytes."""
    o = np.argsort(bucket, kind="stable")
    bucket = bucket[o]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
    columns = [c[o] for c in columns]
    for lo, hi in zip(cut, np.append(cut[1:], len(bucket))):
        cells = [c[lo:hi].tobytes() for c in columns]
        yield (int(bucket[lo]), kind, int(hi - lo), *cells, *[b""] * (len(_CELLS) - len(cells)))


def _blob_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * len(_CELLS)]
    names = ["bucket", "kind", "n", *_CELLS]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _spread_spans(doc, v, start, end, buckets: int) -> Iterator[tuple]:
    doc, v, start, end = _merged(doc, v, start, end)
    yield from _blob_rows(SPAN, doc % buckets, [doc, v, start.astype(np.int32), end.astype(np.int32)])


def _read(group: pd.DataFrame, kind: int, types: Sequence) -> list[np.ndarray]:
    rows = group[group["kind"] == kind]
    return [np.frombuffer(b"".join(rows[c]), t) for c, t in zip(_CELLS, types)]


def _span_frame(doc, v, kind, start, end) -> pd.DataFrame:
    return pd.DataFrame({"_id": doc, "_v": v, "kind": np.full(len(doc), kind, np.int32), "s": start.astype(np.int32), "e": end.astype(np.int32)})


def _total(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("_raw"))).first()[0] or 0


def repeated_spans(docs: DataFrame, length: int = 50, gram: int = 22, total: int | None = None) -> DataFrame:
    """``_id, _v, s, e`` (byte offsets, end exclusive): spans covered by strings of smaller documents.

    ``docs`` has ``_id``, ``_v`` (what tells texts of one id apart) and ``_raw`` (binary). Together a document's spans cover exactly
    the bytes to remove. Records are cut into ``_BUCKETS`` buckets per shuffle
    partition by the hash they are compared by. Before the shuffle a task
    settles all but the smallest document of each string it holds, so a
    passage that very many documents share reaches its bucket once a task.
    ``total``, the bytes of ``_raw``, is summed up here unless given; small
    tables are written by fewer tasks than there are shuffle partitions.
    """
    buckets = _BUCKETS * tasks(docs.sparkSession)
    total = _total(docs) if total is None else total

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            doc, v, s, e, a, g, x, before, after = (np.concatenate(c) for c in zip(*held))
            held.clear()
            g = (g >> np.uint64(32)).astype(np.uint32)
            o, _, later = _smallest((g, x), doc)
            rows = list(_spread_spans(doc[o[later]], v[o[later]], s[o[later]], e[o[later]] + length, buckets))
            o = o[~later]
            rows += _blob_rows(RUN, (g[o] % np.uint32(buckets)).astype(np.int64),
                               [doc[o], v[o], s[o].astype(np.int32), (e - s)[o].astype(np.uint16), (a - s)[o].astype(np.uint16), g[o], x[o],
                                (before[o] >> np.uint64(48)).astype(np.uint16), (after[o] >> np.uint64(48)).astype(np.uint16)])
            if rows:  # none, if all texts held are shorter than a window
                yield _blob_batch(rows)

        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            variants = batch.column(1).to_numpy(zero_copy_only=False)
            raw = batch.column(2).to_pylist()
            for a, b in _blocks(raw):
                d, *rest = anchored_runs(raw[a:b], length, gram)
                held.append((ids[a:b][d], variants[a:b][d], *rest))
                if sum(len(h[0]) for h in held) >= _FLUSH:
                    yield from flush()
        yield from flush()

    def settle_runs(key, group: pd.DataFrame) -> pd.DataFrame:
        doc, v, s, n, a, g, x, *sides = _read(
            group, RUN, (np.int64, np.int64, np.int32, np.uint16, np.uint16, np.uint32, np.uint64, np.uint16, np.uint16))
        e = s + n
        o, _, later = _smallest((g, x), doc)
        known = _merged(doc[o[later]], v[o[later]], s[o[later]], e[o[later]] + length)
        o = o[~later]
        # a gram with its surroundings in one document alone matches nothing; of the others the windows are
        # compared. Short hashes will do here: they only choose what is compared.
        doc_, v_, s_, e_ = doc[o], v[o], s[o].astype(np.int64), e[o].astype(np.int64)
        middle = s_ + a[o] - (length - gram) // 2  # the last start of the first half
        first_half, second_half = (_shared(g[o].astype(np.uint64) << np.uint64(16) | side[o], doc_) for side in sides)
        start = np.where(first_half, s_, np.maximum(s_, middle + 1))
        end = np.where(second_half, e_, np.minimum(e_, middle))
        loose = (first_half | second_half) & (start <= end)
        before = _read(group, SPAN, (np.int64, np.int64, np.int32, np.int32))
        return pd.concat([_span_frame(*before[:2], SPAN, *before[2:]), _span_frame(*known[:2], SPAN, *known[2:]),
                          _span_frame(doc_[loose], v_[loose], RUN, start[loose], end[loose])])

    found = staged(in_files(docs.mapInArrow(runs, _BLOBS).repartition(tasks(docs.sparkSession), "bucket")
                            .groupBy("bucket").applyInPandas(settle_runs, _SPANS), total, _BYTES))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            doc, v, s, h, c = (np.concatenate(x) for x in zip(*held))
            held.clear()
            o, _, later = _smallest((h, c), doc)
            rows = list(_spread_spans(doc[o[later]], v[o[later]], s[o[later]], s[o[later]] + length, buckets))
            o = o[~later]
            rows += _blob_rows(RUN, (h[o] % np.uint64(buckets)).astype(np.int64), [doc[o], v[o], s[o].astype(np.int32), c[o], h[o]])
            if rows:  # none, if all texts held are shorter than a window
                yield _blob_batch(rows)

        size = 0
        for batch in slices(batches, 256):  # a text's runs are many small objects
            for doc, v, raw, rs in zip(*(c.to_pylist() for c in batch.columns)):
                b = np.frombuffer(raw, np.uint8)
                first = np.array([r["s"] for r in rs], np.int64)
                starts = ragged(first, np.array([r["e"] for r in rs], np.int64) - first + 1)
                h = Rolling(b).of(starts, starts + length)
                c = (Rolling(b, BASES[1]).of(starts, starts + length) >> np.uint64(32)).astype(np.uint32)
                held.append((np.full(len(starts), doc), np.full(len(starts), v), starts, h, c))
                size += len(starts)
                if size >= _FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    def settle_windows(key, group: pd.DataFrame) -> pd.DataFrame:
        doc, v, s, c, h = _read(group, RUN, (np.int64, np.int64, np.int32, np.uint32, np.uint64))
        o, _, later = _smallest((h, c), doc)
        o = o[later]
        before = _read(group, SPAN, (np.int64, np.int64, np.int32, np.int32))
        return pd.concat([_span_frame(*before[:2], SPAN, *before[2:]), _span_frame(doc[o], v[o], SPAN, s[o], s[o] + length)])

    release(docs.sparkSession)
    loose = found.filter(F.col("kind") == RUN).groupBy("_id", "_v").agg(F.collect_list(F.struct("s", "e")).alias("_runs"))
    more = staged(in_files(docs.join(loose, ["_id", "_v"]).select("_id", "_v", "_raw", "_runs").mapInArrow(windows, _BLOBS)
                           .repartition(tasks(docs.sparkSession), "bucket").groupBy("bucket").applyInPandas(settle_windows, _SPANS),
                           total, _BYTES))
    release(docs.sparkSession)
    return found.filter(F.col("kind") == SPAN).union(more).select("_id", "_v", "s", "e")


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 22, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    Texts are UTF-8 bytes (null: empty) and matches never cross documents. A
    byte goes when a string of ``length`` bytes that covers it also starts in
    a document with a smaller id, judged on the input; ``n_spans`` counts the
    maximal removed runs and ``kept`` (binary) holds the other bytes. Rows of
    one id count as one document's parts and never remove each other; rows
    without an id are left as they are. Texts under ``length`` bytes keep all.
    An empty table gives an empty result; other columns aren't read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("_raw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [_cut(raw, spans) for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            n, removed, runs, kept = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                ["_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (_with_spans(own, "_id", "_raw", length, gram).select("_id", "_raw", "_spans")
            .mapInArrow(cut, "_id long, n_bytes long, n_removed long, n_spans long, kept binary")
            .withColumnRenamed("_id", id_col))


def drop_repeats(docs: DataFrame, length: int = 50, gram: int = 22, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts that :func:`remove_repeats` keeps; all rows and columns stay.

    Bytes that are left of a character cut in two go as well. A null text
    stays null. Where ``docs`` has ``n_chars``, it is counted anew.
    """
    spans = fresh(docs, "_spans")
    columns = docs.columns
    at = columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t if t is None or not s else _cut(t.encode(), s)[3].decode("utf-8", "ignore")
                     for t, s in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(columns))], columns)

    out = _with_spans(docs, id_col, text_col, length, gram, spans).mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out


def _with_spans(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, name: str = "_spans") -> DataFrame:
    """``docs`` with the array of its spans (null: none) as the last column."""
    key, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    # texts that share an id are told apart by 60 bits of their SHA-256; where ids are distinct that is not needed
    distinct = docs.filter(key.isNotNull()).groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    variant = F.lit(0).cast("long") if distinct else F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    raw = docs.filter(key.isNotNull()).select(key.alias("_id"), variant.alias("_v"), text.alias("_raw"))
    total = _total(raw)
    of, its = fresh(docs, "_of"), fresh(docs, "_its")
    gone = (repeated_spans(raw, length, gram, total).groupBy(F.col("_id").alias(of), F.col("_v").alias(its))
            .agg(F.collect_list(F.struct("s", "e")).alias(name)))
    return in_files(docs.join(gone, (key == F.col(of)) & (variant == F.col(its)), "left").select(*docs.columns, name), total, _BYTES)


def _cut(raw: bytes, spans: list | None) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, maximal removed runs, bytes kept)."""
    if not spans:
        return len(raw), 0, 0, raw
    step = np.zeros(len(raw) + 1, np.int32)
    np.add.at(step, np.minimum([x["s"] for x in spans], len(raw)), 1)
    np.add.at(step, np.minimum([x["e"] for x in spans], len(raw)), -1)
    off = np.cumsum(step[:-1]) > 0
    runs = int(off[:1].sum()) + int((off[1:] & ~off[:-1]).sum())
    return len(raw), int(off.sum()), runs, np.frombuffer(raw, np.uint8)[~off].tobytes()
