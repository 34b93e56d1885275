"""Vectorised text primitives over Arrow string buffers.

Words are found and hashed for a whole block of texts at once: a block is a
byte buffer with row offsets, a word is a maximal run of bytes of a class, and
its 64-bit key is a polynomial of its bytes taken from prefix sums. Buffers are
worked on in chunks, so that only arrays of words grow with a text, and a task
gives back what its allocators hold when it ends.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at a time inside a task.
BLOCK_BYTES = 1 << 20
#: Bytes that are searched and hashed at a time.
CHUNK = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: `[^\x20\x09-\x0D]`
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z
ALNUM = np.ones(256, dtype=bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False
ALNUM[65:91] = True

_WRAP = 1 << 64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = (np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit keys."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and those of its inverse, from 0 to CHUNK."""
    out = []
    for base in (_BASE, pow(_BASE, -1, _WRAP)):
        steps = np.full(CHUNK + 1, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def release() -> None:
    """Give memory that the allocators of this process hold back to the system."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


@functools.cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes of text; a longer row stands alone."""
    _, offsets = text_buffer(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(end, rows)
        at = min(end, rows)


@dataclass
class Words:
    """Words of a block of rows, in order."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word, with the total at the end
    _sums: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def _prefix(self, at: int) -> np.ndarray:
        """Prefix sums of the chunk that begins at byte `at`; kept for blocks of ordinary size."""
        sums = self._sums.get(at)
        if sums is None:
            part = self.buf[at : at + CHUNK]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[part] * _powers()[0][: len(part)], out=sums[1:])
            if len(self.buf) <= 2 * BLOCK_BYTES:
                self._sums[at] = sums
        return sums

    def keys(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit keys of the words, or of one part of each of them; A-Z count as a-z."""
        start, end = self.start if start is None else start, self.end if end is None else end
        h = np.zeros(len(start), dtype=np.uint64)
        _, down = _powers()
        for at in range(0, len(self.buf), CHUNK):
            stop = at + CHUNK
            a, b = np.searchsorted(start, [at, stop])
            over = a > 0 and int(end[a - 1]) > at
            if a == b and not over:
                continue
            sums = self._prefix(at)
            s = start[a:b] - at
            h[a:b] = (sums[np.minimum(end[a:b], stop) - at] - sums[s]) * down[s]
            if over:  # the last part before this chunk goes on in it
                more = int(sums[min(int(end[a - 1]), stop) - at]) * pow(_BASE, at - int(start[a - 1]), _WRAP)
                h[a - 1] = np.uint64((int(h[a - 1]) + more) % _WRAP)
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(column: pa.Array, kind: np.ndarray) -> Words:
    """Words of class `kind` of every row."""
    buf, offsets = text_buffer(column)
    n = len(buf)
    starts, ends = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for at in range(0, n, CHUNK):
        inside = kind[buf[at : at + CHUNK]]
        stop = at + len(inside)
        cuts = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop, side="right")] - at
        joined = np.empty(len(inside) + 1, dtype=bool)  # whether each byte is of one word with the byte before it
        joined[1:-1] = inside[1:] & inside[:-1]
        joined[0] = at > 0 and inside[0] and kind[buf[at - 1]]
        joined[-1] = stop < n and inside[-1] and kind[buf[stop]]
        joined[cuts] = False
        starts.append(np.flatnonzero(inside & ~joined[:-1]) + at)
        ends.append(np.flatnonzero(inside & ~joined[1:]) + (at + 1))
    start, end = np.concatenate(starts), np.concatenate(ends)
    row = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets, side="left")
    return Words(buf, offsets, start, end, row, first)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` over a task's batches, giving back memory when the task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def map_blocks(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """Apply `fn` to blocks of rows whose column `text` holds a bounded number of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column(text), limit):
                out = fn(batch.slice(a, b - a))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(released(run), schema)


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of `values` over the ranges that `first` delimits; empty ranges give 0."""
    size = np.diff(first)
    out = np.zeros(len(size), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(size)
    if len(full):
        out[full] = np.add.reduceat(values.astype(out.dtype), first[:-1][full])
    return out


def binary_array(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary column whose rows are the ranges of `values` that `first` delimits."""
    values = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer((first * values.itemsize).astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())
