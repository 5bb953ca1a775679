"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else (tuple(w[i : i + n]) for i in range(len(w) - n + 1)))


def removed(texts, window):
    """(bytes, removed, spans, hash of the rest) per text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + window] for t in data for i in range(len(t) - window + 1))
    out = []
    for t in data:
        mask = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                mask[i : i + window] = b"\x01" * window
        spans = sum(1 for i in range(len(t)) if mask[i] and not (i and mask[i - 1]))
        kept = bytes(x for x, m in zip(t, mask, strict=True) if not m)
        out.append((len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


def components(ids, texts, n, percent):
    """Smallest id reachable by links, per id."""
    sets = [shingles(t, n) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for h in holders.values() for k, b in enumerate(h) for a in h[:k])
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = top(a), top(b)
            if ids[a] > ids[b]:
                a, b = b, a
            parent[b] = a
    return [ids[top(i)] for i in range(len(ids))], [len(s) for s in sets]


def unigram(ids, texts):
    """Base score, known tokens and tokens per text; training tokens."""
    counts = Counter()
    for i, t in zip(ids, texts, strict=True):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), b""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        w = [*words(t), b""]
        out.append((len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out, n


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i : i + 3])].append(i)
    again = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)
