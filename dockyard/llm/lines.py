"""Removal of lines that are near copies of other lines, by MinHash over character shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.lists import linked_groups
from dockyard.llm.rolling import Rolling, mix, ragged
from dockyard.llm.tables import release, slices, staged, tasks

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: White space other than a blank and the end of a line.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_EMPTY = np.uint64(2**64 - 1)
#: Bits of the filter that keeps lines nobody asks for where they are read; it only saves work.
PLACE_BITS = 1 << 24
#: Stands for a document in that filter; lines have smaller numbers.
_ANY_LINE = 1 << 31
#: Lines, or pairs of lines, whose values are sorted at once: 12 bits of a sort key, beside the 51 of a value.
SORTED = 1 << 12
_VALUE_BITS = 51


def lower(text: str) -> str:
    """A-Z lower-cased."""
    return text.lower() if text.isascii() else text.encode().translate(_LOWER).decode()


def normal_lines(text: str) -> list[str]:
    """:func:`normal` of each line of a text; most texts have no white space that changes."""
    some = lower(text)
    lines = some.split("\n")
    same = not (some[:1] == " " or some[-1:] == " " or "  " in some or " \n" in some or "\n " in some or any(c in some for c in _BLANKS))
    return lines if same else [" ".join(line.split()) for line in lines]


def normal(line: str) -> str:
    """A-Z lower-cased, each run of white space one space, trimmed."""
    return " ".join(lower(line).split())


def shingles(lines: Sequence[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(63-bit hashes of each line's shingles in a row, how many each has). A shorter line is one shingle."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    cp = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    per = np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)
    begin = np.cumsum(lengths) - lengths
    rolling = Rolling(cp)
    every = rolling.fixed(size)  # also across the ends of lines, which aren't taken
    h = every[np.minimum(ragged(begin, per), len(every) - 1)] if len(every) else np.zeros(int(per.sum()), np.uint64)
    few = np.flatnonzero((lengths > 0) & (lengths < size))
    h[(np.cumsum(per) - per)[few]] = rolling.of(begin[few], begin[few] + lengths[few])
    return (h >> np.uint64(1)).astype(np.int64), per


def shingle_sets(lines: Sequence[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct 51-bit hashes of each line's shingles in a row, how many each has)."""
    values, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(lines), SORTED):
        h, per = shingles(lines[at: at + SORTED], size)
        key = _keys(np.arange(len(per)), per, h >> 63 - _VALUE_BITS)
        key.sort()
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        key = key[fresh]
        values.append(key & (1 << _VALUE_BITS) - 1)
        counts.append(np.bincount(key >> _VALUE_BITS, minlength=len(per)))
    return np.concatenate(values), np.concatenate(counts)


def _keys(owner: np.ndarray, counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values behind the number, below ``SORTED``, of who has them: sorted, those of one owner stand together."""
    return np.repeat(owner << _VALUE_BITS, counts) | values


def signatures(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash: the least value of each bin; an empty bin borrows from the next full one."""
    h = mix(values.astype(np.uint64))
    out = np.full((len(counts), bins), _EMPTY)
    cell = (h - h // np.uint64(bins) * np.uint64(bins)).astype(np.int64)  # much faster than the remainder
    cell += np.repeat(np.arange(len(counts)) * bins, counts)
    np.minimum.at(out.reshape(-1), cell, h >> np.uint64(8))
    empty = out == _EMPTY
    after = np.where(empty, 3 * bins, np.arange(bins)).astype(np.int32)
    after = np.concatenate([after, after + bins], axis=1)  # twice, as the first bin follows the last one
    after = np.minimum.accumulate(after[:, ::-1], axis=1)[:, ::-1]
    of, j = np.nonzero(empty & (counts > 0)[:, None])
    out[of, j] = mix(out[of, after[of, j] % bins] + j.astype(np.uint64))  # bins that borrow the same value stay apart
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` signature values."""
    n, m = signature.shape
    out = np.zeros((n, m // rows), np.uint64)
    for r in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, r: m // rows * rows: rows])
    out = mix(out + np.arange(m // rows, dtype=np.uint64))
    return out.astype(np.int64)


def _chunks(sizes: np.ndarray, most: int = 1 << 16, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    at = 0
    total = np.cumsum(sizes)
    while at < len(sizes):
        done = int(total[at - 1]) if at else 0
        stop = min(at + rows, max(at + 1, int(np.searchsorted(total, done + most))))
        yield at, stop
        at = stop


def _packed(made: np.ndarray) -> pa.Array:
    """The upper six bytes of each row's bands. Bands that share these by chance give candidates, not links."""
    data = np.ascontiguousarray(made.astype("<i8").view(np.uint8).reshape(*made.shape, 8)[:, :, 2:])
    ends = np.arange(len(made) + 1, dtype=np.int32) * (6 * made.shape[1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(made), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the upper four bytes of all bands, the two below them)."""
    data = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(-1, 6)
    return tuple(np.ascontiguousarray(c).view(t).ravel() for c, t in ((data[:, 2:], "<u4"), (data[:, :2], "<u2")))


def _places(ids: pa.Array, lines: np.ndarray) -> np.ndarray:
    """The filter's bit of each line; a null id counts as 0."""
    own = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64)
    return (mix(own * np.uint64(0x9E3779B97F4A7C15) + lines.astype(np.uint64)) % np.uint64(PLACE_BITS)).astype(np.int64)


def _place_filter(want: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which every ``_id, line`` of ``want`` has its bit."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(PLACE_BITS // 64, np.int64)
        for batch in batches:
            at = _places(batch.column(0), batch.column(1).to_numpy())
            np.bitwise_or.at(words, at // 64, np.int64(1) << (at % 64))
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(words[some])], ["w", "bits"])

    out = np.zeros(PLACE_BITS // 64, np.int64)
    marked = want.select("_id", "line").mapInArrow(mark, "w int, bits long")
    for r in marked.groupBy("w").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # at most as many rows as the bitmap has words
        out[r["w"]] = r["bits"]
    return out


def alike_lines(met: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The ``a, b`` of ``a, b, _fa, _fb`` whose lines' shingle sets have a Jaccard similarity of ``percent`` per cent or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, j in _chunks(np.array([len(s) + len(t) for s, t in zip(x, y)]), rows=SORTED):
                texts = {t: k for k, t in enumerate(dict.fromkeys(x[i:j] + y[i:j]))}  # most texts are in several pairs
                values, n = shingle_sets(list(texts), shingle)
                first = np.cumsum(n) - n
                a, b = (np.fromiter((texts[t] for t in side[i:j]), np.int64, j - i) for side in (x, y))
                pair = np.flatnonzero(100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
                key = np.concatenate([_keys(pair, n[c[pair]], values[ragged(first[c[pair]], n[c[pair]])]) for c in (a, b)])
                key.sort()
                both = np.bincount(key[1:][key[1:] == key[:-1]] >> _VALUE_BITS, minlength=j - i)
                good = pa.array(100 * both >= percent * (n[a] + n[b] - both))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i).filter(good) for c in (0, 1)], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def line_groups(docs: DataFrame, shingle: int = 8, percent: int = 80, band_count: int = 14, band_rows: int = 5,
                list_size: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, line, kept`` for every line that isn't blank (``line`` counts all lines of the text from 0).

    Two lines are linked when they are equal after :func:`normal`, or when the
    Jaccard similarity of their sets of ``shingle``-character shingles is
    ``percent`` per cent or more; of a component the first line stays, by
    document id and then line number. Candidates share one of ``band_count``
    bands of ``band_rows`` MinHash values, so of links at 0.8 about 99.6 per
    cent are seen, and more above. Rows of one id count as one document whose
    equal lines meet like any other; of rows that repeat id and text, each
    keeps what the others keep. Lines of rows without an id sort first.
    """
    buckets = 4 * tasks(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            where, number, text = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for j, line in enumerate(normal_lines(t)):
                    if line:
                        where.append(i)
                        number.append(j)
                        text.append(line)
            ids = batch.column(0).take(pa.array(where, pa.int64()))
            for a, b in _chunks(np.fromiter(map(len, text), np.int64, len(text))):
                values, n = shingles(text[a:b], shingle)
                made = bands(signatures(values, n, band_count * band_rows), band_rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(number[a:b], pa.int32()),
                     pa.array([hashlib.md5(t.encode()).digest() for t in text[a:b]], pa.binary()),
                     _packed(made)], ["_id", "line", "key", "bands"])

    seen = staged(own.mapInArrow(read, "_id long, line int, key binary, bands binary"))
    first = seen.groupBy("key").agg(F.min(F.struct("_id", "line", "bands")).alias("f"))
    release(docs.sparkSession)
    nodes = staged(first.select(F.monotonically_increasing_id().alias("node"), "key", "f._id", "f.line", "f.bands"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, which = np.unique(batch.column(0).to_numpy() >> 32, return_inverse=True)  # few: ids of a batch lie together
            v, bucket = _unpacked(batch.column(1))
            node = np.repeat(batch.column(0).to_numpy().astype(np.uint32), band_count)
            part = np.repeat(which * buckets, band_count) + bucket.astype(np.int64) % buckets
            order = np.argsort(part, kind="stable")
            part = part[order]
            cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            parts = np.split(order, cut[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cut] % buckets), pa.array(high[part[cut] // buckets]),
                 *[pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in (v, node)]], ["bucket", "high", "v", "node"])

    def shared(key, group: pd.DataFrame) -> pd.DataFrame:
        v, node = (np.frombuffer(b"".join(group[c]), np.uint32).astype(np.int64) for c in ("v", "node"))
        node |= np.repeat(group["high"].to_numpy(np.int64) << 32, group["v"].map(len).to_numpy(np.int64) // 4)
        order = np.argsort(v, kind="stable")
        v, node = v[order], node[order]
        same = v[1:] == v[:-1]
        some = np.append(same, False) | np.append(False, same)
        # sizes play no part here: all count as 1
        return pd.DataFrame({"v": v[some] * buckets + key[0], "node": node[some], "n": np.ones(int(some.sum()), np.int64)})

    lists = staged(nodes.select("node", "bands").mapInArrow(post, "bucket long, high long, v binary, node binary")
                   .repartition(tasks(docs.sparkSession), "bucket").groupBy("bucket")
                   .applyInPandas(shared, "v long, node long, n long"))

    def sets(need: DataFrame) -> DataFrame:
        """A line's text stands for its set: documents stay where they are read, and a text is far smaller than its shingles."""
        want = staged(nodes.join(need, "node").select("node", F.col("key").alias("_key"), F.col("_id").alias("_of"), F.col("line").alias("_at")))
        places = want.select(F.col("_of").alias("_id"), F.explode(F.array(F.col("_at").cast("long"), F.lit(_ANY_LINE))).alias("line"))
        wanted = docs.sparkSession.sparkContext.broadcast(_place_filter(places))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = wanted.value
            for batch in slices(batches):
                at = _places(batch.column(0), np.full(len(batch), _ANY_LINE))
                batch = batch.filter(pa.array((bits[at // 64] >> (at % 64)) & 1 == 1))
                lines = [t.split("\n") for t in batch.column(1).to_pylist()]
                many = np.fromiter(map(len, lines), np.int64, len(lines))
                where, number = np.repeat(np.arange(len(lines)), many), ragged(np.zeros(len(lines), np.int64), many)
                ids = batch.column(0).take(pa.array(where))
                at = _places(ids, number)
                hit = np.flatnonzero((bits[at // 64] >> (at % 64)) & 1)
                texts = [normal(lines[i][j]) for i, j in zip(where[hit].tolist(), number[hit].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(hit)), pa.array(number[hit].astype(np.int32)),
                     pa.array([hashlib.md5(t.encode()).digest() for t in texts], pa.binary()), pa.array(texts, pa.string())],
                    ["_id", "line", "key", "_full"])

        read = own.mapInArrow(run, "_id long, line int, key binary, _full string")
        return (read.join(want, read["_id"].eqNullSafe(want["_of"]) & (read["line"] == want["_at"]) & (read["key"] == want["_key"]))
                .select("node", "_full").dropDuplicates(["node"]))

    release(docs.sparkSession)
    groups = linked_groups(lists, percent, sets, list_size, alike=lambda met, least: alike_lines(met, least, shingle),
                           flat=lambda texts: shingle_sets(texts, shingle))
    release(docs.sparkSession)
    grouped = staged(nodes.select("node", "key", "_id", "line").join(groups, "node").select("key", "_id", "line", "component"))
    stays = grouped.groupBy("component").agg(F.min(F.struct("_id", "line")).alias("_stay"))
    far = grouped.join(stays, "component").select("key", "_stay")
    place = nodes.select("key", F.struct("_id", "line").alias("_own")).join(far, "key", "left").select(
        "key", F.coalesce("_stay", "_own").alias("_stay"))
    return seen.select("_id", "line", "key").join(place, "key").select(
        "_id", "line", (F.col("_id").eqNullSafe(F.col("_stay._id")) & (F.col("line") == F.col("_stay.line"))).alias("kept"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``id, n_lines, n_removed, text`` for every row of ``docs``: the text without the lines that :func:`line_groups` drops.

    Blank lines stay. A null text has no lines and stays null; an empty one
    has one. An empty table gives an empty result; other columns aren't read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    out = (line_groups(docs, id_col=id_col, text_col=text_col, **how).filter("not kept")
           .groupBy(F.col("_id").alias("_of")).agg(F.collect_set("line").alias("_out")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = []
            for t, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t is not None and not gone:
                    made.append((t.count("\n") + 1, 0, t))
                    continue
                lines = [] if t is None else t.split("\n")
                gone = set(gone or ())
                kept = [x for i, x in enumerate(lines) if i not in gone]
                made.append((len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
            n, removed, text = zip(*made) if made else ((),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.string())],
                ["_id", "n_lines", "n_removed", "text"])

    return (own.join(out, F.col("_id").eqNullSafe(F.col("_of")), "left").select("_id", "_text", "_out")
            .mapInArrow(cut, "_id long, n_lines long, n_removed long, text string").withColumnRenamed("_id", id_col))
