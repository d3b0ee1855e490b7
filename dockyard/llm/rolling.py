"""Prefix polynomial hashes over a block of bytes or code points.

All arithmetic is modulo 2**64 (numpy's unsigned wrap-around). With an odd
base every power has an inverse, so the hash of any substring is one
subtraction and one product. Two independent bases give a second opinion
where a collision would change a result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _room(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Substring hashes of one block: ``of(start, end)`` for index arrays."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values)
        power, self._inverse = _powers(_room(n + 1), base)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.prefix[1:])

    def of(self, start, end) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self._inverse[start])

    def fixed(self, k: int) -> np.ndarray:
        """The hash of every substring of length ``k``."""
        p = self.prefix
        n = len(p) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((p[k:] - p[:n]) * self._inverse[:n])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """min(v[i:i+w]) for every i, in three passes whatever ``w`` is."""
    n = len(v)
    if n < w:
        return v[:0]
    m = -(-n // w) * w
    pad = np.full(m, np.iinfo(v.dtype).max, v.dtype)
    pad[:n] = v
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1: n])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the ranges start..start+length, one after another."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


class HashTable:
    """64-bit keys to small integers: open addressing in numpy, whole arrays at a time."""

    def __init__(self, room: int):
        self._bits = max(10, int(room * 2).bit_length())
        self._keys = np.zeros(1 << self._bits, np.uint64)
        self._values = np.full(1 << self._bits, -1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not there yet; the table must keep free slots."""
        slot = self._slots(keys)
        while len(keys):  # each round settles one key a free slot; the others move on
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self._values[slot] == -1)
            self._keys[slot[put]], self._values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & ((1 << self._bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it isn't there."""
        slot = self._slots(keys)
        out = self._values[slot]
        todo = np.flatnonzero((self._keys[slot] != keys) & (out != -1))
        while len(todo):
            slot = (slot[todo] if len(slot) == len(keys) else slot) + 1 & ((1 << self._bits) - 1)
            out[todo] = self._values[slot]
            on = (self._keys[slot] != keys[todo]) & (out[todo] != -1)
            todo, slot = todo[on], slot[on]
        return out
