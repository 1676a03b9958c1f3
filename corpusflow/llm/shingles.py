"""Word shingles as sorted sets of 64-bit hashes, made a slice of texts at a time in numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_POWER, 1 << 16), _powers(_INVERSE, 1 << 16)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(_POWER, 2 * n), _powers(_INVERSE, 2 * n)
    return _UP, _DOWN


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word between ASCII white space, in order; A-Z count as a-z."""
    b = np.frombuffer(text.lower(), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    up, down = _grown(len(b) + 1)
    white = _WHITE[b]
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``words`` words; of a shorter text, of its whole word sequence; empty without words."""
    w = word_hashes(text or b"")
    if not len(w):
        return w
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        h = mix(h + w[i : len(w) - size + 1 + i] * np.uint64(2 * i + 3))
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]
