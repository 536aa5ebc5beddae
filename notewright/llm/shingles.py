"""Words and word shingles of texts as arrays of 64-bit hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MOST_WORDS = 200_000
_ROWS_AT_ONCE = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier, the golden ratio of 64 bits


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch one after the other, few of them as Python strings at a time."""
    for at in range(0, len(column), _ROWS_AT_ONCE):
        yield from column.slice(at, _ROWS_AT_ONCE).to_pylist()


def free_prefix(columns: Iterable[str]) -> str:
    """A prefix that no column name starts with, for columns that are added for a while."""
    prefix = "__"
    while any(name.lower().startswith(prefix) for name in columns):
        prefix += "_"
    return prefix


def give_back() -> None:
    """Return freed memory to the system at the end of a task, as Python workers stay on for the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case; bytes know no other letters or spaces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """Hash of each word, remembered; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = value
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; of fewer words, the whole sequence as one; of none, none."""
    count = len(hashes)
    size = min(size, count)
    if not count:
        return hashes
    joined = hashes[: count - size + 1].copy()
    for k in range(1, size):
        joined = joined * _STEP + hashes[k : count - size + 1 + k]
    return mixed(joined + np.uint64(size))


def shingle_set(text: str | None, size: int, cache: WordHashes) -> np.ndarray:
    """The distinct shingles of a text, ascending."""
    return np.unique(shingles(cache.of(words(text)), size))
