"""Plain, slow versions of the corpus operators."""

from __future__ import annotations

from collections import Counter, defaultdict

import xxhash


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps: dict, most_bits: int = 2) -> dict:
    """id -> smallest id reachable; fps: id -> fingerprint."""
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= most_bits:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def removed_words(docs: list[tuple[int, str | None]], width: int) -> dict:
    """id -> set of places covered by windows that also start earlier."""
    first: dict = {}
    out = defaultdict(set)
    for i, t in sorted(docs, key=lambda d: d[0]):
        words = (t or "").encode().split()
        for p in range(len(words) - width + 1):
            w = tuple(words[p : p + width])
            if first.setdefault(w, (i, p)) != (i, p):
                out[i].update(range(p, p + width))
    return out


def removed_bytes(texts: list[str | None], width: int) -> list[set]:
    """For each text the places covered by strings that occur twice or more."""
    seen: Counter = Counter()
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        seen.update(b[p : p + width] for p in range(len(b) - width + 1))
    return [{q for p in range(len(b) - width + 1) if seen[b[p : p + width]] > 1 for q in range(p, p + width)} for b in raw]


def words_of(text: str | None) -> list[bytes]:
    lower = (text or "").encode().lower()
    return bytes(c if c in b"0123456789abcdefghijklmnopqrstuvwxyz" or c >= 128 else 32 for c in lower).split()


def hits(text: str | None, items: list[tuple[int, str | None]], span: int = 13) -> tuple[int, int, set]:
    """(words, hit words, items found)."""
    words = words_of(text)
    hit, found = set(), set()
    for key, item in items:
        w = words_of(item)
        n = min(len(w), span)
        if not n:
            continue
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in windows:
                hit.update(range(p, p + n))
                found.add(key)
    return len(words), len(hit), found
