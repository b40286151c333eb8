"""Word shingles and MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ** 3 | 1) & (2**64 - 1) for k in range(64)], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; the cache starts anew at `limit` words, which bounds memory."""

    def __init__(self, limit: int = 200_000):
        self.cache: dict[str, int] = {}
        self.limit = limit

    def __call__(self, words: list[str]) -> np.ndarray:
        cache = self.cache
        if len(cache) > self.limit:
            cache.clear()
        out = np.empty(len(words), dtype=np.uint64)
        for i, w in enumerate(words):
            h = cache.get(w)
            if h is None:
                h = cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            out[i] = h
        return out


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words; fewer words, but not none, are one run."""
    n = len(hashes)
    width = min(width, n)
    if not n:
        return hashes
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : n - width + 1 + k] * _MULTIPLIERS[k % 64]
    return mixed(total + np.uint64(width))


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the runs of `width` words, lower-cased, that a text has."""
    return np.unique(runs(hashes(text.lower().split()), width)) if text else np.zeros(0, np.uint64)


class MinHash:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 2**64, bands * rows, dtype=np.uint64)

    def keys(self, shingles: np.ndarray, piece: int = 8192) -> np.ndarray:
        least = np.full(self.bands * self.rows, 2**64 - 1, dtype=np.uint64)
        for start in range(0, len(shingles), piece):
            part = shingles[None, start : start + piece] * self.a[:, None] + self.b[:, None]
            np.minimum(least, part.min(axis=1), out=least)
        by_band = mixed(least).reshape(self.bands, self.rows)
        total = (by_band * _MULTIPLIERS[None, : self.rows]).sum(axis=1, dtype=np.uint64)
        return mixed(total + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of `rows` rows so that a pair at the threshold meets in one with at least this chance."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
