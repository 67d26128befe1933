"""Seeded 64-bit hashing of words and word shingles with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 50_000
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    """word bytes -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _K2
        x = (x ^ (x >> np.uint64(27))) * _K3
        return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def chain(columns: list[np.ndarray], seed: int) -> np.ndarray:
    """One hash per row of equally long columns, order-sensitive."""
    with np.errstate(over="ignore"):
        h = np.full(len(columns[0]), seed, np.uint64)
        for c in columns:
            h = mix(h * _K1 + c)
        return h


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Ascending distinct hashes of the runs of ``width`` words; words are
    what lies between the characters x20 and x09 to x0D, A-Z lower-cased.  A
    text of fewer words has its whole sequence as its one shingle."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if len(h) < width:
        return chain([h[i:i + 1] for i in range(len(h))], len(h))
    return np.unique(chain([h[i:len(h) - width + 1 + i] for i in range(width)], width))
