"""Split texts into pre-tokens and find the distinct ones, a block of texts at a time.

The split is that of ``public_tokenizers.PATTERN``. It is computed from
character classes over a whole block at once; texts with characters whose
class may differ between Unicode versions go through the pattern itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np

from dockyard.llm.rolling import HashTable, Rolling, ragged

LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
_TOP = 0x20C0


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    import unicodedata
    t = np.full(_TOP + 1, UNSURE, np.uint8)
    for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20B0)]:
        t[c] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
    t[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
    return t


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


def _starts(cp: np.ndarray, kind: np.ndarray, doc_start: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """Where pre-tokens start. ``doc_start`` / ``doc_end`` flag the first / last character of a text."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    start = doc_start.copy()
    start[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(start)
    run_end = np.append(runs[1:], n)  # exclusive
    solid = kind[runs] != SPACE
    # a plain space right before a run of another class belongs to that run
    before = runs[solid & ~doc_start[runs]]
    before = before[cp[before - 1] == 32]
    start[before] = False
    start[before - 1] = True
    # of a run of white space before something else, the last character stands alone
    gaps = ~solid & ~doc_end[run_end - 1] & (run_end - runs > 1)
    last = run_end[gaps] - 1
    start[last[cp[last] != 32]] = True
    # 's 't 'm 'd 're 've 'll, where a pre-token starts at the apostrophe
    quote = np.flatnonzero((cp == 39) & start & ~doc_end)
    if len(quote):
        quote = quote[(kind[quote + 1] == LETTER) & (kind[quote] == OTHER)]
        one = cp[quote + 1]
        two = cp[np.minimum(quote + 2, n - 1)]
        has_two = ~doc_end[quote + 1]
        size = np.where(np.isin(one, [115, 116, 109, 100]), 2, 0)
        pair = has_two & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
        size = np.where(pair, 3, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + size
        inside = after[~doc_end[after - 1]]
        start[inside[kind[inside] == LETTER]] = True
    return np.flatnonzero(start)


class Block:
    """The pre-tokens of a block of texts: where each starts and ends, its hash, and how many a text has."""

    def __init__(self, texts: Sequence[str]):
        self.joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        cp = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        kind = _classes()[np.minimum(cp, _TOP)]
        if (kind == UNSURE).any():
            find = _pattern().finditer
            self.start = np.array([base + m.start() for t, base in zip(texts, (ends - lengths).tolist())
                                   for m in find(t)], np.int64)
        else:
            some = lengths > 0
            doc_start, doc_end = np.zeros(len(cp), bool), np.zeros(len(cp), bool)
            doc_start[(ends - lengths)[some]] = True
            doc_end[ends[some] - 1] = True
            self.start = _starts(cp, kind, doc_start, doc_end)
        self.end = np.append(self.start[1:], len(cp))
        self.hash = Rolling(cp).of(self.start, self.end)
        self.counts = np.bincount(np.searchsorted(ends, self.start, "right"), minlength=len(texts))
        # a second opinion on equal hashes: length and sum of code points
        total = np.concatenate([[0], np.cumsum(cp, dtype=np.int64)])
        self.check = (total[self.end] - total[self.start]) * 64 + (self.end - self.start)

    def text(self, i: np.ndarray) -> list[str]:
        return [self.joined[a:b] for a, b in zip(self.start[i].tolist(), self.end[i].tolist())]


def blocks(texts: Sequence[str], size: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` characters; texts with unsure characters stand alone."""
    at = total = 0
    for i, t in enumerate(texts):
        odd = not t.isascii() and max(t) >= chr(0x250) and any(
            ord(c) > _TOP or _classes()[ord(c)] == UNSURE for c in set(t))
        if odd and i > at:
            yield at, i
            at, total = i, 0
        total += len(t)
        if odd or total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


#: Code points up to which a pre-token is known by its hash, length and sum.
LONG = 64


class Encoder:
    """Ids of whole texts from the ids of their distinct pre-tokens.

    ``encode_pieces`` gives the ids of a list of pre-tokens. They are kept for
    the next blocks in a table of bounded size, which only saves work: when
    ``keep`` is passed, the table starts anew. Texts are cut at the strings of
    ``added``, of which the leftmost, then the longest counts; these get their
    own ids, and what is between them is split by itself.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[Sequence[int]]], keep: int = 1 << 19,
                 added: dict[str, int] | None = None):
        self._encode, self._keep, self._added = encode_pieces, keep, added or {}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")
        self._clear(0)

    def _clear(self, new: int) -> None:
        self._table, self._n, self._used = HashTable(self._keep + new), 0, 0
        self._ids = np.zeros(1 << 16, np.int32)
        self._begin, self._size, self._check = (np.zeros(self._keep + new, np.int64) for _ in range(3))

    def _learn(self, block: Block, missing: np.ndarray, short: np.ndarray) -> None:
        hashes, first = np.unique(block.hash[missing], return_index=True)
        if self._n + len(hashes) > len(self._begin):
            self._clear(len(hashes))
            missing = np.flatnonzero(short)
            hashes, first = np.unique(block.hash[missing], return_index=True)
            if len(hashes) > len(self._begin):
                self._clear(len(hashes))
        at = missing[first]
        ids = self._encode(block.text(at))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        if self._used + total > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(max(total, len(self._ids)), np.int32)])
        self._ids[self._used: self._used + total] = np.fromiter((i for x in ids for i in x), np.int32, total)
        rows = np.arange(self._n, self._n + len(hashes))
        self._begin[rows] = self._used + np.cumsum(size) - size
        self._size[rows], self._check[rows] = size, block.check[at]
        self._table.put(hashes, rows)
        self._n, self._used = self._n + len(hashes), self._used + total

    def __call__(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one block of texts after another: (ids of all texts in a row, ids per text)."""
        for a, b in blocks(texts):
            some, cuts = texts[a:b], None
            if any(token in t for token in self._added for t in some):
                # text, token, text, ...: every other part is a token
                cuts = [self._cut.split(t) for t in some]
                some = [part for c in cuts for part in c[::2]]
            block = Block(some)
            # long pre-tokens can be made to share a hash: they are told apart by their text
            short = block.end - block.start <= LONG
            row = self._table.get(block.hash)
            missing = np.flatnonzero((row < 0) & short)
            if len(missing):
                self._learn(block, missing, short)
                row = self._table.get(block.hash)
            short &= row >= 0
            short[short] = self._check[row[short]] == block.check[short]
            per = np.zeros(len(row), np.int64)
            per[short] = self._size[row[short]]
            other = np.flatnonzero(~short)
            pieces = block.text(other)
            known = list(dict.fromkeys(pieces))
            ids = dict(zip(known, self._encode(known))) if known else {}
            per[other] = np.fromiter((len(ids[p]) for p in pieces), np.int64, len(pieces))
            out = np.zeros(int(per.sum()), np.int32)
            starts = np.cumsum(per) - per
            out[ragged(starts[short], per[short])] = self._ids[ragged(self._begin[row[short]], per[short])]
            for i, p in zip(other.tolist(), pieces):
                out[starts[i]: starts[i] + per[i]] = ids[p]
            ends = np.concatenate([[0], np.cumsum(per)])
            stops = np.cumsum(block.counts)
            n = ends[stops] - ends[stops - block.counts]
            if cuts:
                parts = np.fromiter((len(c) // 2 + 1 for c in cuts), np.int64, len(cuts))
                first = np.cumsum(parts) - parts
                follows = np.ones(len(n), bool)
                follows[first] = False
                out = np.insert(out, (np.cumsum(n) - n)[follows], [self._added[t] for c in cuts for t in c[1::2]])
                n = np.add.reduceat(n, first) + parts - 1
            yield out, n
