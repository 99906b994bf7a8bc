"""Nearest centres over the passes of a training, measuring only the rows whose nearest centre may have changed.

A row keeps the position of its centre and a lower bound of its distance to every other one. When the centres move,
the bound falls by the largest move among the others; the distance to the own centre is measured. As long as
it stays below the bound, or below half the distance from the own centre to its nearest neighbour, no other centre
can be as near, and the row is done with one distance. Other rows meet the centres within twice their distance of their own
centre, taken from its list of neighbours, or all centres where that list is long, and get a new bound. Bounds are rounded away from the truth by more than the arithmetic errs, and equal distances are never
taken as done, so positions and distances are those of the full search.
"""

from __future__ import annotations

import numpy as np

from nestmeans.operators import kernels
from nestmeans.operators.spaces import Space, exact_squares

# Bounds pay from about so many centres, and rows for each of them, on.
LEAST_CENTERS, LEAST_ROWS = 128, 16
# Lists of neighbours are kept up to so many centres, and used up to this share of them.
MOST_LISTED, SHORT = 4096, 0.5
_SLACK = 1e-9


def pay(centers: int, rows: int) -> bool:
    return centers >= LEAST_CENTERS and rows >= LEAST_ROWS * centers


def second_bound(x: np.ndarray, centers: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Lower bounds of the distances to all centres but the one at ``at``; infinite without another."""
    n, dim = x.shape
    shift = centers.mean(axis=0)
    right = kernels.prepared(centers - shift)
    error = (dim + 16) * 2.0**-48
    slack = right[-1] * error
    out = np.empty(n)
    height = max(1, kernels._BLOCK_CELLS // max(len(centers), dim + 1))
    for r0 in range(0, n, height):
        part = slice(r0, r0 + height)
        left = np.ones((len(x[part]), dim + 1))
        np.subtract(x[part], shift, out=left[:, :dim])
        own = np.einsum("ij,ij->i", left[:, :dim], left[:, :dim])
        d = left @ right
        d -= slack
        d[np.arange(len(d)), at[part]] = np.inf
        out[part] = d.min(axis=1) + own * (1 - error)
    return np.sqrt(np.maximum(out, 0)) * (1 - _SLACK)


def neighbours(centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every centre all centres by their distance from it, itself first, and lower bounds of the distances in order."""
    moved = centers - centers.mean(axis=0)
    size = np.einsum("ij,ij->i", moved, moved)
    both = size[:, None] + size[None, :]
    squares = both * (1 - (centers.shape[1] + 16) * 2.0**-48) - 2 * (moved @ moved.T)
    far = np.sqrt(np.maximum(squares, 0)) * (1 - _SLACK)
    np.fill_diagonal(far, -1)
    order = far.argsort(axis=1, kind="stable").astype(np.int32)
    return order, np.take_along_axis(far, order, axis=1)


def moves(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Upper bounds of how far every centre has moved."""
    return np.sqrt(exact_squares(after.astype(np.float64), before.astype(np.float64))) * (1 + _SLACK)


class Search:
    """The full search over one set of centres and what later passes need of it."""

    def __init__(self, space: Space, centers: np.ndarray, drift: np.ndarray | None):
        self.space, self.centers = space, centers
        self.ready = space.prepare(centers)
        self.near = None
        if drift is not None:
            if len(centers) <= MOST_LISTED:
                self.near, self.far = neighbours(centers.astype(np.float64))
                self.gaps = self.far[:, min(1, len(centers) - 1)] / 2
            else:
                self.gaps = second_bound(centers, centers, np.arange(len(centers))) / 2
            # the largest move among the others: that of the second for the one that moved most
            most = int(drift.argmax())
            rest = np.delete(drift, most).max(initial=0.0)
            self.fall = np.where(np.arange(len(drift)) == most, rest, drift[most])

    def full(self, x: np.ndarray):
        """(positions, distances, bounds)"""
        at, dist = self.space.nearest(x, self.ready)
        return at, dist, second_bound(x, self.centers.astype(np.float64), at)

    def update(self, x: np.ndarray, at: np.ndarray, low: np.ndarray):
        """(positions, distances, bounds, further distances measured) from the positions and bounds before the move."""
        dist = exact_squares(x, self.centers[at].astype(np.float64))
        own = np.sqrt(dist) * (1 + _SLACK)
        fallen = low - self.fall[at]
        low = np.where(np.isinf(low), low, fallen - np.abs(fallen) * _SLACK)
        open_ = np.flatnonzero(~((own < low) | (own < self.gaps[at])))
        if not len(open_):
            return at, dist, low, 0
        before, at, measured = at, at.copy(), 0
        k = len(self.centers)
        every = []
        if self.near is None:
            every.append(open_)
        else:
            open_ = open_[np.argsort(before[open_], kind="stable")]
            starts = kernels.run_starts(before[open_])
            for a, b in zip(starts, starts[1:]):
                rows, c = open_[a:b], before[open_[a]]
                reach = own[rows].max()
                m = int(np.searchsorted(self.far[c], 2 * reach, side="right"))
                if m > SHORT * k:
                    every.append(rows)
                    continue
                listed = np.sort(self.near[c, :m])
                mine = self.centers[listed]
                found, dist[rows] = self.space.nearest(x[rows], self.space.prepare(mine))
                # centres beyond the list are farther than their distance from the own centre less the row's
                rest = (self.far[c, m] - own[rows]) * (1 - _SLACK)
                low[rows] = np.minimum(second_bound(x[rows], mine.astype(np.float64), found), rest)
                at[rows] = listed[found]
                measured += len(rows) * m
        if every:
            rows = np.concatenate(every)
            at[rows], dist[rows], low[rows] = self.full(x[rows])
            measured += len(rows) * k
        return at, dist, low, measured
