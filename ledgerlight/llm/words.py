"""Vectorised words and hashes over the byte buffers of an Arrow string column.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; all
separators are ASCII, so byte runs of UTF-8 are the same words as code-point
runs.  ``lower`` folds A-Z only.  Word hashes are 64-bit polynomial hashes
(prefix sums modulo 2**64) with a final mix: a few numpy passes per byte and
no Python object per word.  Rows are taken in chunks of about ``CHUNK_BYTES``
(a longer text is a chunk of its own, whole), which bounds the memory of the
passes.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers, fixed by ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + U64(seed)) | U64(1)


def _tables(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    value = np.arange(256, dtype=U64) + U64(1)
    if lower:
        value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return value, space


def _powers(n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in cache or len(cache["up"]) < n + 1:
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(n + 1, base, U64)
            steps[0] = 1
            cache[key] = np.cumprod(steps, dtype=U64)
    return cache["up"], cache["down"]


@dataclass
class Words:
    """The words of the rows ``first <= row < last`` of a column, in order."""

    first: int
    last: int
    row: np.ndarray      # row of each word, absolute
    hash: np.ndarray     # uint64
    start: np.ndarray    # byte positions within ``data``
    end: np.ndarray
    data: np.ndarray     # bytes of the chunk

    def row_bounds(self) -> np.ndarray:
        """Word index at which each row starts, with a closing bound."""
        return np.searchsorted(self.row, np.arange(self.first, self.last + 1))

    def grams(self, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every run of ``n`` words within one row."""
        if len(self.hash) < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        m = len(self.hash) - n + 1
        total = np.zeros(m, U64)
        for k, c in enumerate(multipliers(n, seed)):
            total += self.hash[k:k + m] * c
        at = np.flatnonzero(self.row[:m] == self.row[n - 1:])
        return at, mix(total[at])


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets is not None else np.zeros(1, np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def words(column, lower: bool = True, split_symbols: bool = False) -> Iterator[Words]:
    """The words of an Arrow string column, chunk by chunk of whole rows.

    ``split_symbols`` also splits at each change between word bytes (ASCII
    letters and digits, and all non-ASCII) and ASCII symbols.
    """
    data_all, offsets = buffers(column)
    value, space = _tables(lower)
    kind = np.ones(256, np.uint8)
    if split_symbols:
        kind[33:128] = 2
        for a, b in ((48, 58), (65, 91), (97, 123)):
            kind[a:b] = 1
    kind[space] = 0
    cache: dict = {}
    n_rows, first = len(offsets) - 1, 0
    while first < n_rows:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n_rows)
        data = data_all[offsets[first]:offsets[last]]
        bound = offsets[first:last + 1] - offsets[first]
        if len(data):
            k = kind[data]
            change = np.empty(len(data) + 1, bool)
            change[0] = change[-1] = True
            np.not_equal(k[1:], k[:-1], out=change[1:-1])
            change[bound] = True
            start = np.flatnonzero(change[:-1] & (k > 0))
            end = np.flatnonzero(change[1:] & (k > 0)) + 1
            up, down = _powers(len(data), cache)
            prefix = np.zeros(len(data) + 1, U64)
            np.cumsum(value[data] * up[:len(data)], out=prefix[1:])
            h = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))
            row = np.searchsorted(bound, start, "right") - 1 + first
        else:
            start = end = row = np.zeros(0, np.int64)
            h = np.zeros(0, U64)
        yield Words(first, last, row, h, start, end, data)
        first = last


def per_row_lists(parts: list[tuple[np.ndarray, np.ndarray]], n_rows: int, kind) -> pa.ListArray:
    """A list column from (row, value) parts; rows without values get empty lists."""
    row = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    val = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
    order = np.argsort(row, kind="stable")
    offsets = np.searchsorted(row[order], np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(val[order], kind))
