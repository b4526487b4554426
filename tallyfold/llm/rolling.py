"""Rolling hashes of word windows, as NumPy arrays.

A word's hash is a polynomial over its bytes modulo 2**64, taken as a difference
of prefix sums; a window's hash is the same over the hashes of its words. Each
of two fixed odd bases gives an independent 64-bit value.
"""

from __future__ import annotations

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
CHUNK = 1 << 20  # bytes hashed at a time
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``base`` and of its inverse modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        if n:
            p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def spans_hash(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:stop]`` for every span, whatever its place."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mixed((total[stop] - total[start]) * down[start])


def word_hashes(texts: list[bytes], bases: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per base the hashes of all words of all texts, and the number of words per text."""
    hashes: list[list[np.ndarray]] = [[] for _ in bases]
    counts = np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHUNK):
            size += len(texts[upto]) + 1
            upto += 1
        data = np.frombuffer(b" ".join(texts[at:upto]) + b" ", np.uint8)
        gap = _GAP[data]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(data) and not gap[0]:
            edge = np.concatenate(([0], edge))
        start, stop = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts[at:upto]])
        counts[at:upto] = np.diff(np.searchsorted(start, ends), prepend=0)
        values = data.astype(np.uint64) + np.uint64(1)
        for out, base in zip(hashes, bases):
            out.append(spans_hash(values, start, stop, base))
        at = upto
    return [np.concatenate(h) if h else np.zeros(0, np.uint64) for h in hashes], counts


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hashes of all ``width``-word windows, across the borders of texts too."""
    n = max(0, len(words) - width + 1)
    start = np.arange(n)
    return spans_hash(words, start, start + width, base)
