"""Vectorised word hashing over Arrow text batches.

A word is a maximal run of bytes other than space and 0x09-0x0D.  All work is
done on the concatenated UTF-8 bytes of a bounded chunk of texts, so the cost is
a few numpy passes per byte and no Python loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = 0xC2B2AE3D27D4EB4F | 1
_STEP_INV = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (a table per worker, grown on demand)."""
    table = _POWERS.get(base)
    if table is None or len(table) < n:
        bits = max(20, int(n).bit_length())
        table = np.ones(1 << bits, np.uint64)
        b = base
        for k in range(bits):
            half = 1 << k
            table[half:2 * half] = table[:half] * np.uint64(b)
            b = b * b % (1 << 64)
        _POWERS[base] = table
    return table[:n]


class Words:
    """Words of a chunk of texts: ``hash`` per word, ``first[d]:first[d+1]`` per text, byte ``start``/``end``."""

    __slots__ = ("data", "start", "end", "hash", "first", "bounds")

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool):
        n = len(data)
        if lower:
            up = (data >= 65) & (data <= 90)
            data = data + (up.astype(np.uint8) << 5)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        word = ~gap
        begin = word.copy()
        begin[1:] &= gap[:-1]
        stop = word.copy()
        stop[:-1] &= gap[1:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begin[edges] = word[edges]
        stop[edges - 1] = word[edges - 1]
        self.data, self.bounds = data, bounds
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.hash = span_hashes(data, self.start, self.end)
        self.first = np.searchsorted(self.start, bounds)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[start:end]`` (prefix sums of a polynomial)."""
    acc = np.empty(len(data) + 1, np.uint64)
    acc[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=acc[1:])
    return mix((acc[end] - acc[start]) * powers(_BASE_INV, len(data) + 1)[start])


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values of ``h`` (order matters); empty if fewer."""
    n = len(h)
    if n < k:
        return np.empty(0, np.uint64)
    if k <= 8:
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * np.uint64(_STEP) + h[j:n - k + 1 + j]
        return mix(out)
    acc = np.empty(n + 1, np.uint64)
    acc[0] = 0
    np.cumsum(h * powers(_STEP, n), out=acc[1:])
    return mix((acc[k:] - acc[:-k]) * powers(_STEP_INV, n + 1)[:n - k + 1])


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, text bounds) of runs of texts of about ``limit`` bytes; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    body = texts.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    row, rows = 0, len(texts)
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        stop = min(stop, rows)
        yield row, stop, body[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_chunks(texts: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, Words) for runs of texts."""
    for row, stop, data, bounds in text_chunks(texts, limit):
        yield row, stop, Words(data, bounds, lower)
