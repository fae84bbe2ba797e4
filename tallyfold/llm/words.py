"""Vectorised words, shingles and hashes over Arrow string batches.

A batch of texts is one UTF-8 buffer with offsets. Words are found and hashed with array operations over that buffer,
so no Python object is made per word. Texts are processed in slices of bounded size; a longer text is a slice alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Array operations over a slice make arrays of eight bytes a byte or more: this size keeps most of them in a core's cache.
SLICE_BYTES = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD1B54A32D192ED03)

# Byte classes: what separates words, and what else separates them where punctuation counts as a separator.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {}


def release() -> None:
    """Hand memory that is free back to the system: workers and drivers live on, and the next stage needs it elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            for key, base in (("p", _P), ("i", _P_INV)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                _powers[key] = np.multiply.accumulate(table)
    return _powers["p"], _powers["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of documents: ``first[d]:first[d + 1]`` are those of document ``d``."""

    data: np.ndarray  # the bytes, folded if asked for
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows with at most ``limit`` bytes, or one longer row. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    release()


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``, from one running sum of weighted bytes."""
    n = len(data)
    power, inverse = _power_table(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        h = (sums[end] - sums[start]) * inverse[start]
        return mix(h ^ ((end - start).astype(np.uint64) * _Q))


def split_words(data: np.ndarray, offsets: np.ndarray, fold: bool = True, separators: np.ndarray = SPACE) -> Words:
    n, docs = len(data), len(offsets) - 1
    if fold:
        data = LOWER[data]
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(docs + 1, np.int64), np.zeros(0, np.uint64))
    inside = ~separators[data]
    cut = np.zeros(n + 1, bool)  # a document begins here
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    h = range_hashes(data, start, end)
    return Words(data, start, end, first, h)


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every window of ``n`` words that lies inside one document."""
    total = len(words.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(total - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * _Q + words.hash[k : k + total - n + 1]
        h = mix(h)
    doc = words.doc()
    same = doc[: total - n + 1] == doc[n - 1 :]
    return h[same], doc[: total - n + 1][same]


def shingle_sets(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per document, sorted by document and hash: (hashes, first index per document).

    A document of fewer than ``n`` words has its whole sequence as its only shingle; one without words has none.
    """
    h, doc = ngram_hashes(words, n)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for i, d in enumerate(short):
                value = np.uint64(counts[d])
                for w in words.hash[words.first[d] : words.first[d + 1]]:
                    value = value * _Q + w
                extra[i] = value
            h, doc = np.concatenate([h, mix(extra)]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(len(counts) + 1))


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[d]:first[d + 1]]``; empty segments give 0. Works on the first axis."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
