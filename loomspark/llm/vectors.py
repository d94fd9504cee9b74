"""Columns of vectors as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def dense(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and components, in double precision, of the lists of just so many components that are all finite; nulls are not."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fit = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    at = np.flatnonzero(fit.to_numpy(zero_copy_only=False))
    x = column.filter(fit).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dims)
    fine = np.isfinite(x).all(1)
    return at[fine], x[fine]


def finite_bytes(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """(vec_id, raw): components as bytes, null for vectors that are null, empty, all zeros or hold a null or non-finite one; -0.0 is 0.0."""
    width = np.dtype(kind).itemsize
    for batch in batches:
        column = batch.column(1)
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        x = column.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)
        ends = np.cumsum(size)
        bad, some = np.append(0, np.cumsum(~np.isfinite(x))), np.append(0, np.cumsum(x != 0))
        fine = (bad[ends] == bad[ends - size]) & (some[ends] > some[ends - size])
        data = x.tobytes()
        raw = [data[width * (e - n) : width * e] if f else None for e, n, f in zip(ends.tolist(), size.tolist(), fine, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["vec_id", "raw"])
