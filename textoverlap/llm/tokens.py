"""Vectorised word splitting and hashing of Arrow text columns.

Words are runs of bytes other than space and 0x09-0x0D, so UTF-8 text never has to be decoded. A run of
texts is handled as one byte buffer: word bounds come from a byte table, and word hashes from prefix sums of
a polynomial hash modulo 2**64 (odd base, so dividing by a power of the base is a multiplication).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are handled in runs of about this size; one longer text is one run
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS[base]
    if len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 8 * CHUNK_BYTES:  # a single huge text does not stay in memory
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64 bits (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values * BASE**i``, with a leading zero."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64) * _powers(_BASE, len(values)), out=out[1:])
    return out


def spans_hash(pre: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [lo, hi) of the sequence behind ``pre``."""
    h = (pre[hi] - pre[lo]) * _powers(_INVERSE, len(pre))[lo]
    return mix(h + (hi - lo).astype(np.uint64))


def column_hash(difference: np.ndarray, lo: int, length: int) -> np.ndarray:
    """``spans_hash`` of spans that all start at ``lo`` of their own sequence, from differences of prefix sums."""
    return mix(difference * _powers(_INVERSE, lo + 1)[lo] + np.uint64(length))


def base_powers(n: int) -> np.ndarray:
    return _powers(_BASE, n)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty; no copy where Arrow allows it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf, off


def chunks(column: pa.Array, limit: int = CHUNK_BYTES, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: (first row, last row + 1, bytes, offsets from 0) of about ``limit`` bytes each."""
    buf, off = text_buffer(column)
    at = 0
    while at < len(off) - 1:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        part = buf[off[at]:off[to]]
        yield at, to, (_LOWER[part] if lower else part), off[at:to + 1] - off[at]
        at = to


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per text): text d has words [woff[d], woff[d + 1])."""
    is_word = ~_SPACE[buf]
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    full = off[1:] > off[:-1]
    begin, end = off[:-1][full], off[1:][full] - 1
    first[begin] = is_word[begin]
    last[end] = is_word[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans_hash(prefix(buf.astype(np.uint64) + np.uint64(1)), starts, ends)
