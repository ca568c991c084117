"""Words, shingles and the 64-bit hashing that the operators share.

A word is a maximal run of bytes other than the six ASCII spaces; lower-casing touches
A-Z alone. ``bytes.lower`` and ``bytes.split`` do exactly that.
"""

from __future__ import annotations

import numpy as np
import xxhash

_P1 = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(0xBF58476D1CE4E5B9)
_P3 = np.uint64(0x94D049BB133111EB)
_MASK = 0xFFFFFFFFFFFFFFFF
MAX_CACHED_WORDS = 100_000


def to_bytes(text: str | None) -> bytes:
    """UTF-8; NULL is empty, and a lone surrogate keeps a form of its own."""
    return (text or "").encode("utf-8", "surrogatepass")


def lower_words(text: str | None) -> list[bytes]:
    return to_bytes(text).lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _P2
    x = (x ^ (x >> np.uint64(27))) * _P3
    return x ^ (x >> np.uint64(31))


def seeds64(n: int, salt: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _P1 + np.uint64(salt))


class WordHashes(dict):
    """Hash of a word, remembered; a full memory starts anew, so it stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; fewer words are one shingle."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    size = min(k, n)
    acc = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        acc = acc * _P1 + word_hashes[j : n - size + 1 + j]
        acc ^= acc >> np.uint64(29)
    return np.unique(mix64(acc))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
