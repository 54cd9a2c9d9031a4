"""Vectorised 64-bit hashes of a text's words and word shingles (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_KEY = 0x7A11CA57  # fixed value


def word_hashes(text: bytes, slice_bytes: int = 1 << 20) -> np.ndarray:
    """A keyed 64-bit hash (XXH3) per word; long texts go slice by slice.

    Not a polynomial of the bytes, whose collisions structured words share whatever the base.
    """
    parts, at, digest = [], 0, xxhash.xxh3_64_intdigest
    while at < len(text):
        end = min(len(text), at + slice_bytes)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        words = text[at:end].split()
        parts.append(np.array([digest(w, _KEY) for w in words], dtype=np.uint64))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words, in order; with fewer words, one over all of them."""
    if not len(words):
        return words
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0x2545F4914F6CDD1D) + words[i : len(words) - n + 1 + i]
    return mix(out)
