"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

from ..session import columns

#: A worker's memo of word hashes is emptied at this size; it only saves time.
MEMO = 1_000_000


class WordHashes(dict):
    """Word -> 64-bit hash, the same in every process."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order, repeats kept."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out ^= out >> np.uint64(29)
        out *= _MIX
        out += words[k : n + k]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def offsets(lengths: Iterable[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(lengths, np.int64))]).astype(np.int32)


def lists(flat: np.ndarray, lengths: Iterable[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets(lengths)), pa.array(flat))


def batches(it: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded size, so that long texts do not pile up."""
    for batch in it:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


narrow = columns
