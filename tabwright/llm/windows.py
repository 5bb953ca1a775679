"""Pieces of texts whose windows share an anchor, in numpy, inside a task.

The anchor of a window is the place of the least hash among the runs of ``GRAM`` bytes
inside it (the leftmost of equal ones). It depends on the window's bytes alone, so equal
windows have equal anchors at equal places. Neighbouring windows mostly share an anchor;
the stretch of text they cover is a piece.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

GRAM = 64
_PLACE_BITS = 24
_SLICE = 1 << 22
_BYTE = np.random.default_rng(1).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on."""
    h, step = _BYTE[data], 1
    while step < GRAM:
        h = h[:-step] * np.uint64(pow(_ODD, step, 2**64)) + h[step:]
        step *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima inside blocks."""
    n = values.size
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[:n] = values
    table = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def pieces(text: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash at the anchor, first window, number of windows) of each piece of a text."""
    found = []
    for begin in range(0, max(0, len(text) - window + 1), _SLICE):
        part = text[begin : begin + _SLICE + window - 1]
        if len(part) < window:
            break
        h = gram_hashes(np.frombuffer(part, np.uint8))
        keyed = (h & np.uint64(2**64 - 2**_PLACE_BITS)) | np.arange(h.size, dtype=np.uint64)
        least = sliding_least(keyed, window - GRAM + 1)
        anchor = (least & np.uint64(2**_PLACE_BITS - 1)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        found.append((h[anchor[first]].view(np.int64), first + begin, np.diff(np.concatenate((first, [anchor.size])))))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def anchor_of(piece: bytes, window: int) -> int:
    """Where the anchor of a piece's first window, and so of all its windows, is."""
    h = gram_hashes(np.frombuffer(piece[:window], np.uint8))
    return int(np.argmin(h & np.uint64(2**64 - 2**_PLACE_BITS)))


def digest(piece: bytes) -> int:
    return int.from_bytes(blake2b(piece, digest_size=8).digest(), "little", signed=True)
