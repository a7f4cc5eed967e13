"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, width: int) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(docs: list[tuple[int, str | None]], width: int) -> dict[int, tuple[int, int]]:
    """Set size and component by document, from every pair that shares a shingle."""
    sets = {d: shingle_set(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    shared: Counter = Counter()
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_repeats(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """Removed bytes, removed runs and what is left of each text."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


def sha256(x: bytes | str) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
