"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; a block ends between words, so a longer word makes a longer block.
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SIGN = mix(_LOWER.astype(np.uint64) + np.uint64(1))


class Words(NamedTuple):
    """Hashes of all words of a column in order, and the first word of each row (with the end)."""

    hashes: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _powers(count: int, step: np.uint64) -> np.ndarray:
    powers = np.full(count, step, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words [start, end) of the bytes, modulo 2**64, then mixed."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_SIGN[data] * _powers(len(data), _STEP), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _powers(len(data), _STEP_INVERSE)[starts]
    return mix(own + (ends - starts).astype(np.uint64) * _ODD)


def word_hashes(column: pa.Array) -> Words:
    """Hash each word of a text column: maximal runs without the six ASCII blanks, ``A-Z`` in lower
    case. Null is empty. Equal words have equal hashes; different ones collide by chance of 2**-64."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None or bounds[-1] == bounds[0]:
        return Words(np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64))
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    signs = ~_BLANK[data]
    begins, stops = signs.copy(), signs.copy()
    begins[1:] &= ~signs[:-1]
    stops[:-1] &= ~signs[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins[inner] = signs[inner]
    stops[inner - 1] = signs[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
        low, high = starts[at], ends[to - 1]
        hashes[at:to] = _block(data[low:high], starts[at:to] - low, ends[at:to] - low)
        at = to
    return Words(hashes, np.searchsorted(starts, bounds).astype(np.int64))


def row_blocks(column: pa.Array, limit: int = 1 << 22) -> list[tuple[int, int]]:
    """Bounds of runs of rows with about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    edges = [0, *cuts.tolist(), len(column)]
    return [(low, high) for low, high in zip(edges, edges[1:]) if high > low]
