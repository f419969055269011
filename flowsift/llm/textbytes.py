"""Texts of an Arrow column as one byte buffer, and 64-bit hashes of any part of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
#: A random number for each byte, and the odd base of the polynomial over them.
BYTE_VALUE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
#: Bytes 9-13 and 32 separate words.
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True

_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary array, and len + 1 offsets into them; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most most_bytes, one row at least: first row, end row, bytes, offsets."""
    data, offsets = flat(column)
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def _powers(n: int, way: str) -> np.ndarray:
    if len(_POWERS[way]) < n:
        step = BASE if way == "up" else BASE_INVERSE
        chain = np.full(max(n, 1 << 16), step, np.uint64)
        chain[0] = 1
        _POWERS[way] = np.cumprod(chain, dtype=np.uint64)
    return _POWERS[way][:n]


def scrambled(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PartHashes:
    """Hashes of parts of a buffer that do not depend on where a part stands."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * _powers(n, "up"), out=self.sums[1:])
        self.back = _powers(n + 1, "down")

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scrambled((self.sums[end] - self.sums[start]) * self.back[start]
                         + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of its row. Words end at blanks and row ends."""
    visible = np.zeros(len(data) + 2, bool)
    visible[1:-1] = ~IS_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(visible[1:] & (~visible[:-1] | edge))
    ends = np.flatnonzero(visible[:-1] & (~visible[1:] | edge))
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, row
