"""Hashes of words and shingles of many texts at once, in numpy, inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BLOCK = 1 << 20
_RANDOM = np.random.default_rng(0x5EED)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32  # A-Z in lower case
_BYTE = _BYTE[_TABLE]
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_PLACES = np.cumprod(np.full(4096, _ODD | np.uint64(1), np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(at: np.ndarray) -> np.ndarray:
    """Powers of an odd number by place in the word; long words go on in steps of 4,096."""
    low = _PLACES[at & 4095]
    if at.size and at.max() >= 4096:
        later = (low * mixed((at >> 12).astype(np.uint64))) | np.uint64(1)
        low = np.where(at < 4096, low, later)
    return low


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word of a text, upper and lower case A-Z alike."""
    found = []
    data = np.frombuffer(text, np.uint8)
    start, n = 0, data.size
    while start < n:
        stop = min(n, start + _BLOCK)
        if stop < n:  # go on to the end of the word
            while stop < n and not _BLANK[data[stop]]:
                stop += 1
        part = data[start:stop]
        start = stop
        blank = _BLANK[part]
        edge = np.diff(np.concatenate(([True], blank, [True])).view(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not first.size:
            continue
        sizes = last - first
        letters = np.flatnonzero(~blank)
        place = letters - np.repeat(first, sizes)
        values = _BYTE[part[letters]] * _power(place)
        sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(sizes)[:-1])))
        found.append(mixed(sums + sizes.astype(np.uint64) * _ODD))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of the whole sequence if it is shorter."""
    if not words.size:
        return words
    if words.size < n:
        n = words.size
    total = np.zeros(words.size - n + 1, np.uint64)
    for i in range(n):
        total = mixed(total * _ODD + words[i : i + total.size])
    return total


def batched(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text; many short texts are hashed in one go."""
    waiting: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in waiting])
        joined = b" ".join(waiting) + b" "
        data = np.frombuffer(joined, np.uint8)
        blank = _BLANK[data]
        edge = np.diff(np.concatenate(([True], blank)).view(np.int8))
        first = np.flatnonzero(edge == -1)
        hashes = word_hashes(joined)
        cuts = np.searchsorted(first, ends)
        begin = 0
        for end in cuts:
            yield hashes[begin:end]
            begin = end

    for text in texts:
        text = text or b""
        if len(text) > _BLOCK:
            if waiting:
                yield from flush()
            waiting, size = [], 0
            yield word_hashes(text)
            continue
        waiting.append(text)
        size += len(text) + 1
        if size >= _BLOCK:
            yield from flush()
            waiting, size = [], 0
    if waiting:
        yield from flush()
