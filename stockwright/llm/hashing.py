"""Vectorised 64-bit hashes of words, shingles and byte strings; the same in every task and run."""

from __future__ import annotations

import numpy as np

# Odd random multipliers.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits; one-to-one."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. n - 1`` modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def inverse(base: np.uint64) -> np.uint64:
    """The number whose product with an odd ``base`` is 1 modulo 2**64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


_INVERSE = inverse(_BASE)


def word_hashes(flat: bytes) -> np.ndarray:
    """Hashes of the blank-separated words of a text."""
    return placed_words(flat)[1]


def placed_words(flat: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and hashes of the blank-separated words of a text."""
    b = np.frombuffer(flat, np.uint8)
    filled = b != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], filled, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    # Sum of byte * base**place up to each place; a word's part is moved to its own start.
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(b)), out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(b))[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; of fewer words, the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, width)
    code = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        code = mix(code + words[i : i + n - k + 1] * _WEIGHTS[i % len(_WEIGHTS)])
    return np.unique(code)
