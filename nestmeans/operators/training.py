"""Training of one group inside a task."""

from __future__ import annotations

import numpy as np

from nestmeans.operators import bounds, kernels, limbs
from nestmeans.operators.spaces import Space


def lloyd(space: Space, x: np.ndarray, start: np.ndarray, max_iter: int):
    """Train on ``x`` from the rows ``start``; returns (centres, sizes, objective).

    Stops early only at a fixed point, which further passes could not leave. Sums are exact, so after the first
    pass only rows that change their cluster are taken from one sum and added to the other.
    """
    centers, drift, low, last = start.copy(), None, None, None
    bounded = bounds.pay(len(start), len(x))
    sums: dict[int, np.ndarray] = {}

    def add(rows: np.ndarray, clusters: np.ndarray, sign: int) -> None:
        for limb, part in space.sums(x[rows], clusters, len(start)).items():
            sums[limb] = sums.get(limb, 0) + sign * part

    for turn in range(max_iter):
        if not bounded:
            index, dist = space.nearest(x, space.prepare(centers))
        elif low is None:
            index, dist, low = bounds.Search(space, centers, None).full(x)
        else:
            index, dist, low, _ = bounds.Search(space, centers, drift).update(x, index, low)
        changed = slice(None) if last is None else np.flatnonzero(index != last)
        add(changed, index[changed], 1)
        if last is not None:
            add(changed, last[changed], -1)
        last = index
        sizes = np.bincount(index, minlength=len(centers))
        ids = np.flatnonzero(sizes)
        moved = centers.copy()
        moved[ids] = space.mean({limb: part[ids] for limb, part in sums.items()}, sizes[ids], x.shape[1])
        if turn + 1 < max_iter or space.split_last:
            moved = kernels.refill(moved, sizes, space.steps)
        if np.array_equal(moved, centers) or turn + 1 == max_iter:
            centers = moved
            break
        if bounded:
            drift = bounds.moves(centers, moved)
        centers = moved
    cost = limbs.grouped_sums(dist[:, None], np.zeros(len(x), dtype=np.int64), 1)
    return centers, sizes, limbs.value({limb: part[0, 0] for limb, part in cost.items()})


def train(space: Space, x, k, hashes, row_ids, cut, max_iter):
    """Best of the restarts; column r of ``hashes`` orders the rows of restart r.

    Rows whose hash is below ``cut`` train; the first k of them in hash order start.
    """
    best = None
    for r in range(hashes.shape[1]):
        h = hashes[:, r]
        start = np.lexsort((row_ids, h))[:k]
        chosen = h < cut
        chosen[start] = True
        result = lloyd(space, x if chosen.all() else x[chosen], x[start], max_iter)
        if best is None or result[2] < best[2]:
            best = result
    return best
