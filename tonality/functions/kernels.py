"""Vectorised kernels run inside Arrow UDFs.

This module is pickled *by value* into the UDFs, so Python workers need only
numpy and pyarrow, not this package on their path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def signed_bincount_unit(indices: pa.Array, dim: int) -> pa.Array:
    """Rows of signed 1-based bucket indices (+-(b + 1)) -> L2-normalised
    dense rows of length ``dim`` (list<double>), for a whole Arrow batch.

    One ``bincount`` over (row * dim + bucket) for the batch; rows with no
    tokens (or null) stay all zeros.
    """
    lists = indices if indices.type == pa.list_(pa.int32()) else indices.cast(pa.list_(pa.int32()))
    n = len(lists)
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    pos = rows * dim + (np.abs(flat).astype(np.int64) - 1)
    dense = np.bincount(pos, weights=np.sign(flat).astype(np.float64), minlength=n * dim)
    # an empty batch gives an integer result; the output is always float64
    dense = dense.astype(np.float64, copy=False).reshape(n, dim)
    norm = np.sqrt(np.einsum("ij,ij->i", dense, dense))
    np.divide(dense, norm[:, None], out=dense, where=norm[:, None] > 0)
    values = pa.array(dense.reshape(-1), type=pa.float64())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32)), values)


def padded(lists: pa.Array) -> np.ndarray:
    """Rows of a list array as a matrix; what a row lacks, and nulls, are NaN."""
    size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    out = np.full((len(lists), int(size.max(initial=0))), np.nan)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if lists.null_count:
        size = np.where(np.asarray(lists.is_valid()), size, 0)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def pair_moments(x: np.ndarray) -> np.ndarray:
    """For each pair of columns, over the rows that have both: number of rows,
    mean of the first, mean of the second, sum of products about the means.
    Shape (4, d, d)."""
    has = ~np.isnan(x)
    shift = np.divide(np.nansum(x, axis=0), np.maximum(has.sum(axis=0), 1))
    y = np.where(has, x - shift, 0.0)
    m = has.astype(np.float64)
    n = m.T @ m
    known = np.maximum(n, 1)
    first = (y.T @ m) / known
    product = y.T @ y - n * first * first.T
    return np.stack([n, first + shift[:, None], first.T + shift[None, :], product])


def merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The moments of two sets of rows together; the smaller is padded."""
    d = max(a.shape[1], b.shape[1])
    a, b = (np.pad(v, ((0, 0), (0, d - v.shape[1]), (0, d - v.shape[1]))) for v in (a, b))
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    di, dj = np.where(a[0] > 0, b[1] - a[1], b[1]), np.where(a[0] > 0, b[2] - a[2], b[2])
    empty = (a[0] == 0) | (b[0] == 0)
    product = a[3] + b[3] + np.where(empty, 0.0, di * dj * a[0] * share)
    mean = lambda k, diff: np.where(b[0] == 0, a[k], np.where(a[0] == 0, b[k], a[k] + diff * share))
    return np.stack([n, mean(1, di), mean(2, dj), product])


def moment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's moments of all pairs i <= j of the components of its vectors."""
    total = None
    for batch in batches:
        x = padded(batch.column(0))
        if x.size:
            found = pair_moments(x)
            total = found if total is None else merged_moments(total, found)
    if total is not None:
        i, j = np.triu_indices(total.shape[1])
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(v[i, j]) for v in total]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "n", "mean_i", "mean_j", "product"])
