"""NumPy steps that run inside Spark tasks, on Arrow batches or on groups of bounded size.

Unless said otherwise coordinates are integers held as float64. Every product and sum stays below 2**53, so
results are exact and the same for any batch size, partitioning or order of addition. ``spaces`` has
the steps for coordinates of any spread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_EXACT = float(1 << 53)
_BLOCK_CELLS = 1 << 19
_BLOCK_CENTERS = 2048
_SUM_ROWS = 1 << 14
_EXACT_SINGLE, _LEAST_NARROW = float(1 << 24), 64


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as an (n, dim) array; any other width or a NULL is an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten()
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or values.null_count or (lengths != dim).any():
        raise ValueError(f"every vector needs {dim} elements and no NULL")
    return values.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def on_grid(x: np.ndarray, scale: float) -> np.ndarray:
    x = np.floor(x.astype(np.float64) * float(scale) + 0.5)
    if x.size:
        top = np.abs(x).max()
        if not 4.0 * x.shape[1] * top * top < _EXACT:
            raise ValueError("vectors hold NaN or are too long for this scale; lower it")
    return x


def prepared(centers: np.ndarray) -> np.ndarray:
    """Centres as :func:`nearest_prepared` wants them: -2c by column, and |c|^2 below."""
    right = np.empty((centers.shape[1] + 1, len(centers)))
    np.multiply(centers.T, -2.0, out=right[:-1])
    np.einsum("ij,ij->j", right[:-1], right[:-1], out=right[-1])
    right[-1] /= 4.0
    return right


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre; the lowest index wins ties."""
    return nearest_prepared(x, prepared(centers))


def nearest_prepared(x: np.ndarray, ready: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """|c|^2 - 2xc comes from one matrix product with a column of ones, in blocks that stay in cache.

    The work space is bounded by the rows at hand and by a block, whatever the number of centres.
    """
    n, dim = x.shape
    centers = ready.shape[1]
    index, best = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
    width = min(_BLOCK_CENTERS, max(1, centers))
    height = max(1, min(n, _BLOCK_CELLS // max(width, dim + 1)))
    cells, every = np.empty((height, width)), np.arange(height)
    padded = np.ones((height, dim + 1))
    for c0 in range(0, centers, width):
        right = ready[:, c0 : c0 + width]
        for r0 in range(0, n, height):
            rows = x[r0 : r0 + height]
            left = padded[: len(rows)]
            left[:, :dim] = rows
            d = np.matmul(left, right, out=cells[: len(left), : right.shape[1]])
            at = d.argmin(axis=1)
            found = d[every[: len(left)], at]
            better = found < best[r0 : r0 + height]
            best[r0 : r0 + height][better] = found[better]
            index[r0 : r0 + height][better] = at[better] + c0
    return index, best + np.einsum("ij,ij->i", x, x)


def nearest_bits(x: np.ndarray, ready: np.ndarray, one: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`nearest_prepared` for rows of nothing but 0 and ``one``: the product of zeros and ones with the centres is an
    integer below 2**24, see :func:`narrow`, so single precision holds it exactly, at half the time."""
    n, dim = x.shape
    centers = ready.shape[1]
    index, best = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
    width = min(_BLOCK_CENTERS, max(1, centers))
    height = max(1, min(n, _BLOCK_CELLS // max(width, dim + 1)))
    short, cells, every = np.empty((height, width), np.float32), np.empty((height, width)), np.arange(height)
    bits = (x != 0).astype(np.float32)
    for c0 in range(0, centers, width):
        right = (ready[:-1, c0 : c0 + width] / -2.0).astype(np.float32)
        square = ready[-1, c0 : c0 + width]
        for r0 in range(0, n, height):
            left = bits[r0 : r0 + height]
            product = np.matmul(left, right, out=short[: len(left), : len(square)])
            d = np.multiply(product, -2.0 * one, out=cells[: len(left), : len(square)], dtype=np.float64)
            d += square
            at = d.argmin(axis=1)
            found = d[every[: len(left)], at]
            better = found < best[r0 : r0 + height]
            best[r0 : r0 + height][better] = found[better]
            index[r0 : r0 + height][better] = at[better] + c0
    return index, best + np.einsum("ij,ij->i", x, x)


def narrow(x: np.ndarray, ready: np.ndarray, one: float) -> bool:
    """Whether :func:`nearest_bits` is exact for these rows and centres, and worth its preparation."""
    if len(x) < _LEAST_NARROW or ready.shape[1] < _LEAST_NARROW or len(ready) <= _LEAST_NARROW:
        return False
    # every product and partial sum is a whole number no larger than the sum of a centre's coordinates
    top = max(-ready[:-1].min(), ready[:-1].max()) / 2.0
    return top * x.shape[1] < _EXACT_SINGLE and bool(((x == 0) | (x == one)).all())


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Start positions of runs of equal keys, and the end position."""
    n = len(keys[0])
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [n])) if n else np.array([0])


def integer_sums(x: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
    """Sums of the rows that share a slot."""
    sums = np.zeros((slots, x.shape[1]))
    for r0 in range(0, len(x), _SUM_ROWS):
        part = slot[r0 : r0 + _SUM_ROWS]
        order = np.argsort(part, kind="stable")
        first = run_starts(part[order])[:-1]
        sums[part[order][first]] += np.add.reduceat(x[r0 : r0 + _SUM_ROWS][order], first, axis=0)
    return sums.astype(np.int64)


def divide(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Integer mean, truncated toward zero."""
    s = sums.astype(np.int64)
    return np.sign(s) * (np.abs(s) // counts.astype(np.int64)[:, None])


def split_steps(centers: np.ndarray) -> np.ndarray:
    """Signed offset that separates the two halves of a split cluster."""
    sign = np.where(np.arange(centers.shape[1]) % 2 == 0, 1, -1)
    return np.maximum(1, np.abs(centers) // 1024) * sign


def refill(centers: np.ndarray, counts: np.ndarray, steps=split_steps) -> np.ndarray:
    """Give the e-th empty cluster one half of the e-th largest cluster (two rows or more)."""
    empty = np.flatnonzero(counts == 0)
    if len(empty):
        donors = np.lexsort((np.arange(len(counts)), -counts))
        donors = donors[counts[donors] >= 2][: len(empty)]
        empty = empty[: len(donors)]
        step = steps(centers[donors])
        centers[empty] = centers[donors] + step
        centers[donors] = centers[donors] - step
    return centers


def first_rows(index: np.ndarray, dist: np.ndarray, row_ids: np.ndarray) -> np.ndarray:
    """Mask of the row nearest to its centre in every cluster; the lowest row id wins ties."""
    order = np.lexsort((row_ids, dist, index))
    mask = np.zeros(len(index), dtype=bool)
    mask[order[run_starts(index[order])[:-1]]] = True
    return mask
