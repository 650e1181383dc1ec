"""Texts in Arrow batches as flat byte arrays, and running ranges over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def utf8(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 bytes of a string column end to end and the offsets of its rows; null is empty."""
    column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if not len(column):
        return b"", np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return b"", at - at[0]
    return bytes(memoryview(data)[at[0] : at[-1]]), at - at[0]


def texts(column: pa.Array) -> Iterator[bytes]:
    data, at = utf8(column)
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        yield data[begin:end]


def blocks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about `size` bytes; a longer row is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = max(first + 1, min(last, rows))
        yield first, last
        first = last


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring offsets; 0 for an empty range."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column of the bytes between neighbouring offsets."""
    if len(data) < 2**31:
        return pa.Array.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        )
    return pa.array([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
