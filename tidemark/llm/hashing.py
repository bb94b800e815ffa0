"""64-bit hashes of words and word runs of whole Arrow batches, as NumPy arrays.

A word's hash is a polynomial over random values of its bytes, a run's one over its
words' hashes; both come from running sums, so the cost per byte or word is a few array
operations whatever the run's length. Texts are taken in slices of about ``SLICE_BYTES``
so that the arrays stay small; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype="uint64")
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]  # A-Z as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 3  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, 1 << 20), base, dtype="uint64")
        steps[0] = 1
        table = _powers[base] = np.multiply.accumulate(steps)
    return table[:n]


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    h = h + np.uint64(salt)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of some rows: ``first[r]:first[r + 1]`` are row r's; ``start`` and ``end``
    are byte places in ``data``."""

    data: np.ndarray
    rows: slice
    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def runs(self, k: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``k`` words from each word on; of no meaning where a row has fewer left."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(n, dtype="uint64")
        own = mixed(self.hashes, salt) if salt else self.hashes
        sums = np.concatenate([np.zeros(1, "uint64"), np.cumsum(own * _power(_BASE, n))])
        out = np.zeros(n, dtype="uint64")
        out[: n - k + 1] = mixed((sums[k:] - sums[: n - k + 1]) * _power(_INVERSE, n)[: n - k + 1], k)
        return out

    def whole(self, row: int, salt: int = 0) -> int:
        """Hash of all words of a row in order, with their number."""
        own = self.hashes[self.first[row] : self.first[row + 1]]
        own = mixed(own, salt) if salt else own
        total = (own * _power(_BASE, len(own))).sum(dtype="uint64")
        return int(mixed(np.array([total], "uint64"), len(own))[0])


def words_of(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Slices of rows of a text column, in order; nulls have no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    if not len(column):
        return
    kind = "int64" if pa.types.is_large_string(column.type) else "int32"
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype("int64")
    data = np.frombuffer(data, "uint8") if data is not None else np.zeros(0, "uint8")
    row = 0
    while row < len(column):
        upto = max(int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1, row + 1)
        upto = min(upto, len(column))
        yield _words(data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row], slice(row, upto), lower)
        row = upto


def _words(data: np.ndarray, offsets: np.ndarray, rows: slice, lower: bool) -> Words:
    n = len(data)
    solid = ~_BLANK[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    padded = np.concatenate([[False], solid, [False]])
    start = np.flatnonzero(solid & (~padded[:n] | edge[:n]))
    end = np.flatnonzero(solid & (~padded[2:] | edge[1:])) + 1
    sums = np.concatenate([np.zeros(1, "uint64"), np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * _power(_BASE, n))])
    h = (sums[end] - sums[start]) * _power(_INVERSE, n + 1)[start]
    hashes = mixed(h ^ ((end - start).astype("uint64") << np.uint64(40)))
    return Words(data, rows, hashes, np.searchsorted(start, offsets), start, end)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view("int64")
