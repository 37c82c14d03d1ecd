"""Word grams as 64-bit hashes, computed with numpy for many texts at once."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 400_000


class WordHashes(dict):
    """Hashes of words, kept up to a bound so that memory does not grow with the vocabulary."""

    def __init__(self, limit: int = _CACHE_WORDS):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts, and the texts' bounds."""
        bounds = np.cumsum([0, *map(len, texts)])
        found = map(self.__getitem__, chain.from_iterable(texts))
        return np.fromiter(found, np.uint64, int(bounds[-1])), bounds

    def of_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`of` for the words of binary texts, each different word looked up once."""
        numbers, bounds, words = numbered(column)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))[numbers], bounds


def split(column: pa.Array) -> list[list[bytes]]:
    """Words of binary texts, cut at the six ASCII white-space characters; none for null."""
    return [t.split() if t else [] for t in column.to_pylist()]


def numbered(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of :func:`split` as numbers, the texts' bounds among them, and the different words."""
    lists = pc.ascii_split_whitespace(column.view(pa.string()))
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    # white space at either end of a text leaves an empty word there
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.cumsum(np.r_[0, real])
    bounds = before[np.cumsum(np.r_[0, counts])]
    coded = (flat if real.all() else flat.filter(pa.array(real))).dictionary_encode()
    words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)  # much faster than to_pylist()
    return coded.indices.to_numpy(), bounds, words.tolist()


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values, mixed so that single bits are usable."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += values[k : k + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def starts(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a run of ``size`` words lies within one text, and that text's number."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - first[owner] + bounds[:-1][owner], owner
