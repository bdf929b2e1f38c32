"""Shingles and sets of many sentences at once, for Arrow batches: each sentence's own row gives its whole set, so nothing
is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 4 << 20  # sentences are handled in runs of about this size; a longer one is a run of its own


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary column without nulls."""
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)), off.astype(np.int64)


def runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of sentences: (first row, last row + 1, bytes, offsets from 0)."""
    if not len(column):
        return
    data, off = bytes_of(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + RUN_BYTES, side="right")) - 1)
        yield at, to, data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


def shingle_rows(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, code, weight)`` of every k-byte shingle, by sentence and position: the bytes as a number, and their sum
    weighted by place."""
    count = np.maximum(np.diff(off) - k + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + off[:-1][owner]
    code, weight = np.zeros(len(owner), dtype=np.int64), np.zeros(len(owner), dtype=np.int64)
    for i in range(k):
        byte = data[begin + i].astype(np.int64)
        code = code << 8 | byte
        weight += byte * (i + 1)
    return owner, code, weight


def first_by(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Indices of the first row of each (owner, value), ordered by both."""
    if not len(owner):
        return np.zeros(0, dtype=np.int64)
    place, high = len(owner).bit_length(), int(value.max()).bit_length()
    if int(value.min()) >= 0 and int(owner[-1]).bit_length() + high + place < 64 and int(owner.max()) == owner[-1]:
        # owner, value and place share a long, and numbers are sorted many times faster than indices
        packed = np.sort(owner << (high + place) | value << place | np.arange(len(owner)))
        new = np.ones(len(packed), dtype=bool)
        new[1:] = packed[1:] >> place != packed[:-1] >> place
        return packed[new] & ((1 << place) - 1)
    order = np.lexsort((value, owner))  # stable: equal rows keep their order
    o, v = owner[order], value[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return order[new]


def offsets_of(owner: np.ndarray, n: int) -> np.ndarray:
    """Where each owner's rows begin, for rows that stand by owner."""
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)
