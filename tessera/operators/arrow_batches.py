"""Arrow record batches <-> numpy matrices for ``mapInArrow`` kernels.

A list column's values sit in one flat buffer, so a batch of equal-width
rows is an ``(n, d)`` matrix without touching rows one by one (pandas would
build one object per cell)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(batch: pa.RecordBatch, col: str, width: int | None = None) -> np.ndarray:
    """The list column ``col`` as a float64 ``(n, d)`` matrix; rows must be
    non-null, without null elements and of one width."""
    arr = batch.column(batch.schema.get_field_index(col))
    n = len(arr)
    if n == 0:
        return np.zeros((0, width or 0))
    if arr.null_count:
        raise ValueError(f"null feature vectors in {col}")
    lens = pc.list_value_length(arr).to_numpy(zero_copy_only=False)
    d = int(lens[0])
    if (lens != d).any() or (width is not None and d != width):
        raise ValueError("rows of uneven feature width")
    flat = arr.flatten()
    if flat.null_count:
        raise ValueError(f"null elements in {col}")
    vals = flat.to_numpy(zero_copy_only=False)
    return np.asarray(vals, dtype=np.float64).reshape(n, d)


def vector(batch: pa.RecordBatch, col: str, dtype=np.float64) -> np.ndarray:
    """A scalar column; nulls raise (cast to integers they would be garbage)."""
    arr = batch.column(batch.schema.get_field_index(col))
    if arr.null_count:
        raise ValueError(f"null values in {col}")
    return np.asarray(arr.to_numpy(zero_copy_only=False), dtype=dtype)


def list_column(m: np.ndarray) -> pa.Array:
    """An ``(n, d)`` matrix as a ``list<double>`` array."""
    m = np.asarray(m, dtype=np.float64)
    n, d = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32)) if n else pa.array([0], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))


def expand_2(m: np.ndarray) -> np.ndarray:
    """The degree-2 expansion of every row, in the order of ``vectors.poly_expand_2``:
    per column k itself, then its products with columns 0 to k."""
    n, d = m.shape
    out = np.empty((n, d * (d + 3) // 2))
    for k in range(d):
        at = k * (k + 3) // 2
        out[:, at] = m[:, k]
        np.multiply(m[:, :k + 1], m[:, k:k + 1], out=out[:, at + 1:at + k + 2])
    return out


def expanded(m: np.ndarray, degree: int) -> np.ndarray:
    if degree not in (1, 2):
        raise ValueError("degree is 1 or 2")
    return m if degree == 1 else expand_2(m)
