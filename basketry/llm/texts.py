"""Whole text columns as byte arrays: words, word hashes and the split for held-out rows.

The functions here run inside Arrow tasks.  They look at a string column as one byte buffer
with offsets and work on it in slices of bounded size, so that no Python object is made per
word and a very long text needs no more memory than several short ones.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from basketry.session import ship_package

#: Bytes of a slice; a slice only grows beyond it for a single word that is longer.
SLICE = 1 << 18
#: ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, return.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all documents that nothing may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _byte_codes(fold: bool) -> np.ndarray:
    """A fixed pseudo-random code for every byte; with fold, A-Z share those of a-z."""
    b = np.arange(256, dtype=np.uint64)
    if fold:
        b[65:91] += np.uint64(32)
    return mix((b + np.uint64(1)) * np.uint64(_BASE))


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_POWERS["up"]) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.empty(size, np.uint64)
            p[0] = 1
            done = 1
            while done < size:
                step = min(done, size - done)
                p[done : done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(SEPARATORS)] = True


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def separators(kept: bytes) -> np.ndarray:
    """A table that makes every ASCII byte but the kept ones a separator."""
    table = np.zeros(256, bool)
    table[:128] = True
    table[list(kept)] = False
    return table


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE, separator: np.ndarray = _SEPARATOR) -> Iterator[tuple[int, int]]:
    """Cut the bytes into runs of about ``size`` that end with a row or at a separator."""
    start, end = 0, int(offsets[-1])
    while start < end:
        stop = min(start + size, end)
        if stop < end:
            row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if row_end > start:
                stop = row_end
            else:  # inside one long row: after the next separator, or the row's end
                row_end = int(offsets[np.searchsorted(offsets, start, "right")])
                while stop < row_end:
                    found = np.flatnonzero(separator[data[stop : min(stop + size, row_end)]])
                    if len(found):
                        stop += int(found[0]) + 1
                        break
                    stop = min(stop + size, row_end)
        yield start, stop
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, start: int, stop: int, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words in a slice: the row, first byte and byte after the last."""
    inside = ~separator[data[start:stop]]
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z, z
    first, last = inside.copy(), inside.copy()
    edge = np.zeros(len(inside) + 1, bool)
    cuts = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop, "right")] - start
    edge[cuts] = True
    edge[0] = edge[-1] = True
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin = np.flatnonzero(first) + start
    return np.searchsorted(offsets, begin, "right") - 1, begin, np.flatnonzero(last) + 1 + start


def span_hashes(data: np.ndarray, start: int, stop: int, begin: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes within a slice, equal for equal strings."""
    up, down = _powers(stop - start + 1)
    total = np.empty(stop - start + 1, np.uint64)
    total[0] = 0
    np.cumsum(_byte_codes(fold)[data[start:stop]] * up[: stop - start], out=total[1:])
    return mix((total[end - start] - total[begin - start]) * down[begin - start] + (end - begin).astype(np.uint64))


def word_hashes(column: pa.Array, separator: np.ndarray = _SEPARATOR) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of each word (A-Z lower-cased), in order, slice by slice."""
    data, offsets = column_bytes(column)
    for start, stop in slices(data, offsets, separator=separator):
        row, begin, end = word_spans(data, offsets, start, stop, separator)
        if len(row):
            yield row, span_hashes(data, start, stop, begin, end)


def hash_word(word: str) -> int:
    """The hash ``word_hashes`` gives this word."""
    data = np.frombuffer(word.encode(), np.uint8)
    n = np.array([len(data)], np.int64)
    return int(span_hashes(data, 0, len(data), np.zeros(1, np.int64), n)[0])



def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function that gives freed memory back to the system when it ends: the Python
    worker lives on, beside an executor that needs the memory."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


#: Rows of an Arrow batch: whole texts travel in them, and either side holds some at a time.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """Ship this package to the workers, and lower the session's Arrow batches from Spark's
    default to ``BATCH_ROWS`` rows (a size the user has chosen stays)."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)
