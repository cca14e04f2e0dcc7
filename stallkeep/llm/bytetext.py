"""Words of whole texts as numpy arrays, straight from Arrow's string buffers.

A word is a run of bytes other than space and \\x09-\\x0D. Its hash is a
polynomial over its bytes mod 2**64, so that all words of a block come from one
running sum. Work arrays cover `PIECE` bytes at a time: a very long text costs
memory for its words (8 bytes each), not for its bytes.
"""

from __future__ import annotations

import ctypes
import sys

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
BLOCK = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RATIO = 0x9E3779B97F4A7C15 | 5
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE)
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
                for base in (np.uint64(_RATIO), np.uint64(pow(_RATIO, -1, 1 << 64)))
            ]
    return _powers


class Words(NamedTuple):
    """Words of several texts in order. `bounds[i]:bounds[i+1]` are text i's."""

    hash: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The text each word is of."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def give_back() -> None:
    """Return to the system what a worker's allocators hold and don't use: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `limit` bytes, or one longer text."""
    data, offsets = buffers(column)
    first = 0
    while first < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        stop = min(max(stop, first + 1), first + 20_000)
        yield first, stop, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop
    if len(offsets) and offsets[-1] - offsets[0] >= BLOCK // 2:
        give_back()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, bytes]]:
    """(row, bytes of its text) of a batch; a null text is an empty one."""
    for first, stop, data, offsets in blocks(batch.column(name)):
        for k in range(stop - first):
            yield first + k, data[offsets[k] : offsets[k + 1]].tobytes()


def gathered(rows: Iterable[tuple], fields: dict[str, pa.DataType], limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about `limit` bytes of texts or 5,000 rows, or of one longer row. Texts come as bytes."""
    waiting: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = []
        for values, kind in zip(zip(*waiting, strict=True), fields.values(), strict=True):
            columns.append(pa.array(values, pa.binary()).cast(kind) if pa.types.is_string(kind) and any(isinstance(v, bytes) for v in values) else pa.array(values, kind))
        return pa.record_batch(columns, list(fields))

    for row in rows:
        waiting.append(row)
        size += sum(len(value) for value in row if isinstance(value, (bytes, str)))
        if size >= limit or len(waiting) >= 5000:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts `data[offsets[i]:offsets[i+1]]`."""
    found, low, n = [], 0, len(data)
    while low < n:
        high = min(low + PIECE, n)
        if high < n:
            gap = np.flatnonzero(SPACE[data[low:high]])
            if len(gap):
                high = low + int(gap[-1]) + 1
            else:  # a word longer than a piece
                while high < n and not SPACE[data[high]]:
                    high += 1
        found.append(_piece(data, offsets, low, high, lower))
        low = high
    hashes, start, end = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Words(hashes, np.searchsorted(start, offsets), start, end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, equal for equal bytes wherever they stand. Costs 32 bytes a byte of `data`."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _piece(data, offsets, low: int, high: int, lower: bool):
    part = data[low:high]
    solid = ~SPACE[part]
    cuts = offsets[(offsets > low) & (offsets < high)] - low
    before = np.concatenate([np.zeros(1, bool), solid[:-1]])
    before[cuts] = False
    after = np.concatenate([solid[1:], np.zeros(1, bool)])
    after[cuts - 1] = False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return span_hashes(LOWER[part] if lower else part, start, end), start + low, end + low


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the runs of `size` words inside one text; none where a text has fewer."""
    n = len(words.hash)
    count = np.maximum(np.diff(words.bounds) - size + 1, 0)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    if n < size or not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    joined = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        joined = joined * np.uint64(0xD6E8FEB86659FD93) + words.hash[k : n - size + 1 + k]
    where = np.repeat(words.bounds[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
    return mix(joined[where]), bounds


def sequence_hash(hashes: np.ndarray) -> int:
    """One hash of a whole run of words, used where there are too few for a shingle."""
    value = np.uint64(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            value = mix(np.array([value * np.uint64(0xD6E8FEB86659FD93) + h]))[0]
    return int(value)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `values` in each text; 0 where it has none."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
