"""Vectors as one binary value each, which Spark shuffles, caches and hands to Python without a look inside.

Rows whose coordinates are all 0 or 1 take one bit for each, in whole 64-bit words: 256 bits are 32 bytes instead of
2,048. Other rows keep the space's stored type. The length of a value tells which it is, so rows of both kinds may mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from nestmeans.operators import kernels
from nestmeans.operators.spaces import Space

_WORD = 8


def bit_bytes(dim: int, space: Space) -> int:
    """Bytes of a row of bits; 0 where the stored type is no longer than that."""
    size = -(-dim // (8 * _WORD)) * _WORD
    return size if size < np.dtype(space.stored).itemsize * dim else 0


def pack(x: np.ndarray, space: Space) -> pa.Array:
    """Rows of loaded coordinates as binary values."""
    n, dim = x.shape
    width = bit_bytes(dim, space)
    if width and ((x == 0) | (x == space.one)).all():
        data = np.zeros((n, width), dtype=np.uint8)
        bits = np.packbits(x != 0, axis=1, bitorder="little")
        data[:, : bits.shape[1]] = bits
    else:
        data = np.ascontiguousarray(x, dtype=space.stored)
    size = data.nbytes // n if n else 0
    ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * size)
    return pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(data.tobytes())])


def unpack(column: pa.Array | pa.ChunkedArray, dim: int, space: Space) -> np.ndarray:
    """The loaded coordinates of binary values, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        parts = [unpack(c, dim, space) for c in column.chunks]
        return np.concatenate(parts) if parts else np.zeros((0, dim))
    n = len(column)
    if not n:
        return np.zeros((0, dim))
    if column.null_count:
        raise ValueError("a packed vector is NULL")
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32, count=n + 1, offset=4 * column.offset)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    width = bit_bytes(dim, space)
    short = np.diff(ends) == width if width else np.zeros(n, dtype=bool)
    if short.all():
        return _from_bits(data[ends[0] : ends[-1]].reshape(n, width), dim, space)
    if not short.any():
        return data[ends[0] : ends[-1]].view(space.stored).reshape(n, dim).astype(np.float64)
    x = np.empty((n, dim))
    x[short] = _from_bits(data[ends[:-1][short][:, None] + np.arange(width)], dim, space)
    size = np.dtype(space.stored).itemsize * dim
    x[~short] = data[ends[:-1][~short][:, None] + np.arange(size)].view(space.stored)
    return x


def _from_bits(data: np.ndarray, dim: int, space: Space) -> np.ndarray:
    return np.unpackbits(data, axis=1, count=dim, bitorder="little") * float(space.one)


def packed_rows(rows: DataFrame, vec: str, dim: int, space: Space, out: str = "packed") -> DataFrame:
    """``rows`` with the vectors loaded and packed as the last column, in place of ``vec``."""
    names = [c for c in rows.columns if c != vec]
    fields = [rows.schema[c] for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = space.load(kernels.matrix(batch[vec], dim))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pack(x, space)], [*names, out])

    return rows.select(*names, vec).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))
