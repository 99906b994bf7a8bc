"""How coordinates are held, compared and averaged: as they are, or on an integer grid.

Both spaces give the same result for any partitioning, batch size and order. ``Plain`` keeps every bit of the
coordinates, whatever their spread: distances are added coordinate by coordinate in a fixed order, means are exact
sums divided and rounded once. ``Grid`` rounds to whole multiples of ``1 / scale`` first and cuts means to it as
well, which SQL can follow with integers.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from nestmeans.functions.vectors import to_grid
from nestmeans.operators import kernels, limbs

# Coordinates beyond have squares that a double does not hold.
LARGEST = 2.0**500
_PAIRS, _IN_CACHE = 1 << 20, 1 << 17
_LEAST_STEP = 2.0**-40
_PACKED = {"tinyint": "<i1", "smallint": "<i2", "int": "<i4", "float": "<f4"}


def exact_squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to the same row of ``c``, added in order of the coordinates."""
    total = np.zeros(len(x))
    step = _IN_CACHE // max(1, x.shape[1]) + 1
    for start in range(0, len(x), step):
        part = slice(start, start + step)
        gap = np.ascontiguousarray((x[part] - c[part]).T)
        gap *= gap
        for row in gap:
            total[part] += row
    return total


class Ready(NamedTuple):
    """Centres as ``Plain.nearest`` wants them: moved by ``shift``, with -2c by column and |c|^2 below, and ``slack``,
    which bounds the rounding that a centre adds to a distance."""

    centers: np.ndarray
    shift: np.ndarray
    right: np.ndarray
    slack: np.ndarray


@dataclass(frozen=True)
class Plain:
    """Coordinates as they are. ``stored`` is the type in which cached rows keep them."""

    stored: str = "<f8"

    element = "double"
    unit = 1.0
    one = 1.0
    # the centroids returned are means: none is split after the last pass
    split_last = False

    @classmethod
    def of(cls, element: str) -> Plain:
        """For rows with arrays of the Spark type ``element``."""
        return cls(_PACKED.get(element, "<f8"))

    def column(self, vec: Column | str) -> Column:
        vec = F.col(vec) if isinstance(vec, str) else vec
        return vec.cast("array<double>")

    def load(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        if not np.abs(x).max(initial=0.0) < LARGEST:
            raise ValueError("vectors hold NaN, infinite or too large coordinates")
        return x

    def prepare(self, centers: np.ndarray) -> Ready:
        shift = centers.mean(axis=0)
        moved = centers - shift
        right = kernels.prepared(moved)
        return Ready(centers, shift, right, right[-1] * self._error(centers.shape[1]))

    @staticmethod
    def _error(dim: int) -> float:
        return (dim + 16) * 2.0**-50

    def nearest(self, x: np.ndarray, ready: Ready) -> tuple[np.ndarray, np.ndarray]:
        """A matrix product bounds all distances; what the bounds leave open is added up coordinate by coordinate."""
        n, dim = x.shape
        k = len(ready.centers)
        index, best = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
        width = min(kernels._BLOCK_CENTERS, k)
        height = max(1, min(n, kernels._BLOCK_CELLS // max(width, dim + 1)))
        cells, padded = np.empty((height, width)), np.ones((height, dim + 1))
        for r0 in range(0, n, height):
            rows = x[r0 : r0 + height]
            left = padded[: len(rows)]
            np.subtract(rows, ready.shift, out=left[:, :dim])
            own = np.einsum("ij,ij->i", left[:, :dim], left[:, :dim]) * (2 * self._error(dim))
            every = np.arange(len(rows))
            for c0 in range(0, k, width):
                right, slack = ready.right[:, c0 : c0 + width], ready.slack[c0 : c0 + width]
                d = np.matmul(left, right, out=cells[: len(rows), : right.shape[1]])
                at = d.argmin(axis=1)
                bound = d[every, at] + slack[at] + own
                d -= slack
                open_ = d <= bound[:, None]
                several = np.flatnonzero(np.count_nonzero(open_, axis=1) > 1)
                found = exact_squares(rows, ready.centers[c0 + at])
                if len(several):
                    at[several], found[several] = self._settled(rows, ready.centers[c0 : c0 + width], several, open_)
                better = found < best[r0 : r0 + height]
                best[r0 : r0 + height][better] = found[better]
                index[r0 : r0 + height][better] = at[better] + c0
        return index, best

    @staticmethod
    def _settled(rows: np.ndarray, centers: np.ndarray, several: np.ndarray, open_: np.ndarray):
        """Lowest of the nearest centres of rows for which several are in question, and the distances."""
        at, found = np.zeros(len(several), dtype=np.int64), np.zeros(len(several))
        step = max(1, _PAIRS // len(centers))
        for s0 in range(0, len(several), step):
            part = several[s0 : s0 + step]
            row, column = np.nonzero(open_[part])
            dist = exact_squares(rows[part[row]], centers[column])
            order = np.lexsort((column, dist, row))
            first = order[kernels.run_starts(row[order])[:-1]]
            at[s0 : s0 + step], found[s0 : s0 + step] = column[first], dist[first]
        return at, found

    def sums(self, x: np.ndarray, slot: np.ndarray, slots: int) -> dict[int, np.ndarray]:
        return limbs.grouped_sums(x, slot, slots)

    def mean(self, sums: dict[int, np.ndarray], counts: np.ndarray, dim: int) -> np.ndarray:
        return limbs.quotient(sums, counts) if sums else np.zeros((len(counts), dim))

    def steps(self, centers: np.ndarray) -> np.ndarray:
        """How far the halves of a split centre lie from it: a direction that no line of rows is square to by symmetry."""
        size = np.abs(centers)
        longest = size.max(axis=1, keepdims=True)
        longest = np.where(longest == 0, _LEAST_STEP, longest)
        place = np.arange(centers.shape[1], dtype=np.int64)
        sign = (2 * ((place * 40503 + 12345) % 65536) + 1) / 65536 - 1
        return (size + longest) / 1024 * sign

    def steps_column(self, grid: Column | str) -> Column:
        longest = F.array_max(F.transform(grid, lambda x: F.abs(x)))
        longest = F.when(longest == 0, _LEAST_STEP).otherwise(longest)

        def step(x: Column, place: Column) -> Column:
            sign = (2 * ((place * 40503 + 12345) % 65536) + 1) / F.lit(65536.0) - 1
            return (F.abs(x) + longest) / 1024 * sign

        return F.transform(grid, step)


@dataclass(frozen=True)
class Grid:
    """Whole multiples of ``1 / scale``; every product and sum of a distance stays below 2**53."""

    scale: float

    element = "int"
    stored = "<i4"
    split_last = True

    @property
    def unit(self) -> float:
        return float(self.scale) ** 2

    @property
    def one(self) -> float:
        """What a coordinate of 1 becomes."""
        return float(np.floor(float(self.scale) + 0.5))

    def column(self, vec: Column | str) -> Column:
        return to_grid(vec, self.scale)

    def load(self, x: np.ndarray) -> np.ndarray:
        return kernels.on_grid(x, self.scale)

    def prepare(self, centers: np.ndarray) -> np.ndarray:
        return kernels.prepared(centers)

    def nearest(self, x: np.ndarray, ready: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if kernels.narrow(x, ready, self.one):
            return kernels.nearest_bits(x, ready, self.one)
        return kernels.nearest_prepared(x, ready)

    def sums(self, x: np.ndarray, slot: np.ndarray, slots: int) -> dict[int, np.ndarray]:
        return {0: kernels.integer_sums(x, slot, slots)}

    def mean(self, sums: dict[int, np.ndarray], counts: np.ndarray, dim: int) -> np.ndarray:
        return kernels.divide(sums[0], counts) if sums else np.zeros((len(counts), dim))

    def steps(self, centers: np.ndarray) -> np.ndarray:
        return kernels.split_steps(centers)

    def steps_column(self, grid: Column | str) -> Column:
        return F.transform(
            grid,
            lambda x, i: F.greatest(F.lit(1), F.floor(F.abs(x) / F.lit(1024)).cast("int"))
            * F.when(i % 2 == 0, F.lit(1)).otherwise(F.lit(-1)),
        )


Space = Plain | Grid


def space_of(scale: float | None, element: str = "double") -> Space:
    return Plain.of(element) if scale is None else Grid(scale)


def cluster_sums(space: Space, x: np.ndarray, index: np.ndarray):
    """(ids, row counts, sums by limb) of the clusters that occur."""
    ids, slot = np.unique(index, return_inverse=True)
    return ids, np.bincount(slot, minlength=len(ids)), space.sums(x, slot, len(ids))
