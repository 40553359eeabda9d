"""Words of a text, and stable hashes of them, for the operators that work on words inside tasks.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage
return; ``bytes.split()`` cuts UTF-8 at exactly these. A null text has no words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

MIX = np.uint64(0x9E3779B97F4A7C15)


def payloads(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """word -> 64-bit hash, remembered; forgotten when it holds too many words."""

    LIMIT = 50_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive entries, in order of their starts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + hashes[k : k + n]) * MIX
        out ^= out >> np.uint64(29)
    return mixed(out)


def release() -> None:
    """Give memory that a task no longer needs back to the machine: Spark keeps Python workers for later tasks, beside others'."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)


def rows(batches: Iterator[pa.RecordBatch], size: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``size`` rows, so that what is made of a cut stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
    release()
