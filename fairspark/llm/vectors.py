"""Vectors as whole numbers in binary columns: prepared once, read as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textvec import flat

#: Components are whole numbers below this in size: sums of products then fit 64-bit integers.
LIMIT = 1 << 23


def pack_rows(rows: np.ndarray, dtype: str) -> pa.Array:
    """A matrix as one binary value per row."""
    data = np.ascontiguousarray(rows, dtype=dtype)
    width = data.dtype.itemsize * data.shape[1]
    off = np.arange(len(data) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(off), pa.py_buffer(data)]).cast(pa.binary())


def unpack_rows(col: pa.Array, dtype: str, width: int | None = None) -> np.ndarray:
    """The matrix of ``pack_rows``; rows shorter than the longest (or ``width``) end in zeros."""
    buf, off = flat(col)
    size = np.diff(off) // np.dtype(dtype).itemsize
    d = max(width or 0, int(size.max(initial=0)))
    values = np.frombuffer(buf.tobytes(), dtype)
    if (size == d).all():
        return values.reshape(len(size), d)
    out = np.zeros((len(size), d), dtype)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def whole_vectors(df: DataFrame, vector: str, keep: dict[str, Column], scale: int = 256,
                  dim: int | None = None) -> DataFrame:
    """``(*keep, v binary)``: each component x as ``floor(scale * x)``, x as double, in 32 bits.

    Rows go whose vector is null, holds a null or non-finite component, or has not ``dim``
    components (any number where ``dim`` is None).  A component of ``LIMIT`` or more is an error.
    ``keep`` names columns of whole numbers; no other column of ``df`` is read.
    """
    names, n = [*keep, "v"], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(n)
            size = np.where(np.asarray(lists.is_valid()), np.asarray(lists.value_lengths().fill_null(0)), 0).astype(np.int64)
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(size)), size)
            good = np.asarray(lists.is_valid()) & (np.bincount(row[~np.isfinite(x)], minlength=len(size)) == 0)
            if dim is not None:
                good &= size == dim
            x = np.floor(x[good[row]] * scale)
            if len(x) and np.abs(x).max() >= LIMIT:
                raise ValueError(f"a vector component times {scale} is not below {LIMIT}")
            take = pa.array(np.flatnonzero(good))
            off = np.concatenate([[0], np.cumsum(size[good] * 4)]).astype(np.int64)
            v = pa.Array.from_buffers(pa.large_binary(), len(take), [None, pa.py_buffer(off), pa.py_buffer(x.astype("<i4"))])
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(take) for i in range(n)], v.cast(pa.binary())], names=names)

    cols = [c.cast("long").alias(n) for n, c in keep.items()]
    return df.select(*cols, F.col(vector).alias("v")).mapInArrow(run, ", ".join(f"{n} long" for n in keep) + ", v binary")
