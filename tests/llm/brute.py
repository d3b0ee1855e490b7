"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(t: str) -> bytes:
    return bytes(x + 32 if 65 <= x <= 90 else x for x in t.encode())


def shingles(t: str | None, words: int) -> frozenset:
    w = WORD.findall(lower(t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + words]) for i in range(max(1, len(w) - words + 1)))


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_components(docs: list[tuple[int, str | None]], words: int, percent: int) -> dict:
    """doc_id -> (set size, component id); every pair that shares a shingle of its exact prefix is compared."""
    sets = {i: shingles(t, words) for i, t in docs}
    often = defaultdict(int)
    for s in sets.values():
        for x in s:
            often[x] += 1
    lists = defaultdict(list)
    for i, s in sets.items():
        need = -(-percent * len(s) // 100)
        for x in sorted(s, key=lambda x: (often[x], x))[: len(s) - need + 1]:
            lists[x].append(i)
    pairs = {(a, b) if a < b else (b, a) for ids in lists.values() for a in ids for b in ids if a != b}
    links = []
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            links.append((a, b))
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def repeated_bytes(docs: list[tuple[int, str | None]], length: int = 50) -> dict:
    """doc_id -> (bytes, removed, runs, kept bytes)."""
    first: dict[bytes, int] = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i in sorted(raw):
        b = raw[i]
        for p in range(len(b) - length + 1):
            first.setdefault(b[p: p + length], i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p: p + length]] < i:
                gone[p: p + length] = b"\1" * length
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out[i] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out
