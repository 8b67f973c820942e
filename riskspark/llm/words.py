"""Words of whole texts as bytes, and Rabin-Karp hashes of word windows. Helpers that run inside tasks.

`bytes.split()` cuts at 0x20 and 0x09-0x0D and nothing else, `bytes.lower()` lowers A-Z and nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multipliers of the polynomial hash and of its finishing mix; any odd 64-bit numbers would do.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93

CACHE_WORDS = 100_000


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, null as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hash of a word, remembered for the most recent words; the memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.size = base, 0
        self.up = self.down = np.zeros(0, np.uint64)

    def grow(self, size: int) -> None:
        if size > self.size:
            self.size = max(size, 2 * self.size, 1024)
            for name, step in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                values = np.full(self.size, step, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        """Hash of every `width` consecutive values, from prefix sums; empty if there are fewer."""
        starts = len(values) - width + 1
        if starts <= 0:
            return np.zeros(0, np.uint64)
        return self.spans(values, np.arange(starts), np.arange(width, width + starts))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair."""
        self.grow(len(values) + 1)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=prefix[1:])
        return mixed((prefix[ends] - prefix[starts]) * self.down[starts])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the weak low bits of a polynomial hash over the whole word."""
    values = values.astype(np.uint64, copy=False)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(MIX)
    return values ^ (values >> np.uint64(29))


def ragged(arrays: list[np.ndarray], dtype) -> pa.ListArray:
    """Arrow list column of one numpy array per row."""
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays).astype(dtype, copy=False) if arrays else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

