"""Words of whole texts as 64-bit hashes in numpy arrays, for operators that count or compare shingles."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that a task remembers the hash of, at most.
REMEMBERED = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to 64-bit hash; forgets all when full."""

    def __missing__(self, word) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words; the whole sequence where there are fewer; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    out = mixed(hashes[: n - k + 1] + np.uint64(k * int(_MIX) % 2**64))
    for i in range(1, k):
        out = mixed(out * np.uint64(3) + hashes[i : n - k + 1 + i])
    return out


def trim() -> None:
    """Give memory that a finished batch left behind back to the system, where the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
