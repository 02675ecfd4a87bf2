"""Words of texts as 64-bit hashes in numpy arrays, for operators on word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

KEPT_WORDS = 60_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    """Hashes of the words this worker has met, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hash = _Hashes().__getitem__


def hash_words(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, found), np.uint64, len(found))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers, another one for each salt."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))
