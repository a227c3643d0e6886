"""Whole Arrow columns of text as byte arrays: word bounds and 64-bit word hashes without a Python loop.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes. Work goes on in slices of at most ``SLICE``
bytes that end at a word's end, so memory stays bounded however long one text is (a single word longer
than a slice is taken whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 21
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, U(base))
            x[0] = 1
            _powers.append(np.multiply.accumulate(x))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits (splitmix64's)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[start:end], equal for equal spans wherever they stand."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U)
    np.cumsum((codes.astype(U) + U(1)) * up[: len(codes)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h ^ ((ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null as empty) and the n + 1 bounds of the rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slice after slice: the hashes of its words, and the row each is in."""
    n, at = len(data), 0
    while at < n:
        end = min(n, at + SLICE)
        if end < n:
            # A word that runs on past the slice is left to the next one, or the slice grows by it.
            first_row, last_row = np.searchsorted(bounds, [at, end], "right")
            cuts = np.flatnonzero(SPACE[data[at:end]])
            last = max(at + cuts[-1] + 1 if len(cuts) else at, bounds[last_row - 1])
            if last > at:
                end = int(last)
            else:
                while end < n and not SPACE[data[end]] and end < bounds[last_row]:
                    end += 1
        part = data[at:end]
        word = ~SPACE[part]
        rows = bounds[np.searchsorted(bounds, at, "right") - 1 : np.searchsorted(bounds, end, "left") + 1]
        cut = np.zeros(len(part) + 1, bool)
        cut[0] = cut[-1] = True
        cut[rows[(rows >= at) & (rows <= end)] - at] = True
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = word[:-1]
        starts = np.flatnonzero(word & (~before | cut[:-1]))
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = word[1:]
        ends = np.flatnonzero(word & (~after | cut[1:])) + 1
        codes = LOWER[part] if lower else part
        yield span_hashes(codes, starts, ends), np.searchsorted(bounds, starts + at, "right") - 1
        at = end


def word_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words in each row."""
    n = len(bounds) - 1
    out = np.zeros(n, np.int64)
    at = 0
    while at < len(data):
        end = min(len(data), at + 4 * SLICE)
        word = ~SPACE[data[at:end]]
        start = word.copy()
        start[1:] &= ~word[:-1]
        if at and not SPACE[data[at - 1]]:
            start[0] = False
        rows = bounds[(bounds >= at) & (bounds < end)] - at
        start[rows] = word[rows]
        total = np.zeros(len(word) + 1, np.int64)
        np.cumsum(start, out=total[1:])
        inside = np.clip(bounds, at, end) - at
        out += np.diff(total[inside])
        at = end
    return out


def strings(texts: list[str | None]) -> pa.Array:
    return pa.array(texts, pa.string())


def parts(batches: Iterator[pa.RecordBatch], size: int = 1 << 22, rows: int = 2_048) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with about ``size`` bytes of text at a time, or one row."""
    for batch in batches:
        data, bounds = utf8(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            end = min(end, at + rows)
            yield batch.slice(at, end - at), data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
            at = end
