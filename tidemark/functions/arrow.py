"""Arrow list columns as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as one float64 matrix, without a Python object per row.

    A null vector or entry, or vectors of different lengths, would shift all values
    behind them, so they raise."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count or column.flatten().null_count:
        raise ValueError("null vectors or entries; split them off first")
    if len(column) and pc.count_distinct(pc.list_value_length(column)).as_py() > 1:
        raise ValueError("vectors of different lengths; split them off first")
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def as_lists(matrix: np.ndarray) -> pa.ListArray:
    """A matrix as one list per row."""
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype="int32")
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))
