"""Word and shingle hashes for code that runs inside tasks."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

#: Words whose hash is remembered per Python worker.
CACHED_WORDS = 400_000

_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


class WordHashes(dict):
    """64-bit hash of a word given as UTF-8 bytes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers that leaves no visible pattern."""
    x = x + _MIX[2]
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, known: WordHashes, *, lower: bool) -> np.ndarray:
    """Hashes of the runs without ASCII white space, in order; A-Z lower-cased on demand.

    Lower-casing and splitting work on bytes, where both concern ASCII alone.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = (data.lower() if lower else data).split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` words; fewer words are one shingle, no word is none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    combined = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        combined = mixed(combined ^ words[k : len(words) - size + 1 + k])
    return combined
