"""Near-duplicate vectors by range search in a robust-pruned flat graph.

1. Vectors of a label with the same direction (components over the largest one, equal to 2^-40) become one
   node that counts its copies.
2. The nodes of a label are cut into overlapping shards: each goes to the ``OVERLAP`` nearest of centroids
   fitted on a bounded sample of its group; groups that are still too large are cut again. What no
   centroid separates is dealt by a hash and marked as tied.
3. Each shard builds a flat graph: nodes enter in doubling batches, a greedy search finds their
   candidates, robust pruning keeps up to ``DEGREE`` neighbours of diverse directions, and reverse edges are
   pruned alike.
4. The adjacency lists of a node from all its shards are united. A shard is searched with its own
   nodes and the near neighbours their united lists name in other shards.
5. Every node is a query in its nearest shard: greedy search from the shard's medoids, then expansion through all
   nodes within ``SLACK`` of the query until the range is exhausted. What is found is verified by
   cosine in double precision.
6. Two bounded samples of queries, of all nodes and of nodes with links, are compared with all nodes of
   their label. While the recall of those that stay with the search is below ``MIN_RECALL``, the search is repeated
   with a wider beam and more overlap; if it stays below, step 7 takes all nodes.

7. Tied nodes, and dense ones (with more near nodes in reach of their shard than the ``DEGREE`` that a list can name
   elsewhere), are compared with all nodes of their label in exact products: blocks of them are sent to every
   task, which leaves out the rows that the triangle inequality on a block's centroid and radius rules out. Nodes
   whose links to these outnumber what the search had found for them follow, until there are none.

Tasks report a number of links for each node and a forest of links, never the pairs of a group.
Scale: every step is a shuffle by shard, node or key; shards hold about ``SHARD`` nodes whatever the
size of the table.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components, rows with a NULL label or
NULL id link with nothing; vectors of different length are never compared; repeated rows count once;
zero rows give zero rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.common import let
from nestmeans.llm.components import components
from nestmeans.scratch import checkpoint

THRESHOLD = 0.98
SLACK = 0.9
SHARD = 1500
OVERLAP = 2
MAX_CENTROIDS = 64
SAMPLE_PER_CENTROID = 16
MAX_LEVELS = 8
OVERLAP_LEVELS = 2
DEGREE = 24
BEAM = 48
ALPHA = 1.2
AUDIT = 256
MIN_RECALL = 0.95
ATTEMPTS = 3
EXPANSION = 300_000
CHUNK_BYTES = 16 << 20
ROWS = 2000


# --- the graph of one shard ---------------------------------------------------------------------


def _first(order: np.ndarray, n: int) -> np.ndarray:
    """Columns of the ``n`` largest values of each row, largest first."""
    return np.argsort(-order, axis=1, kind="stable")[:, :n]


def greedy(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries side by side: ``(nodes, similarities)`` of each beam, -1 where unfilled.

    ``entries`` holds the start nodes of each query.
    """
    q = np.arange(len(queries))
    seen = np.zeros((len(queries), len(x)), bool)
    nodes = np.full((len(queries), beam), -1)
    sims = np.full((len(queries), beam), -np.inf, np.float32)
    open_ = np.zeros((len(queries), beam), bool)

    def meet(rows: np.ndarray, fresh: np.ndarray) -> None:
        fresh = fresh.copy()
        fresh[(fresh >= 0) & seen[rows[:, None], np.maximum(fresh, 0)]] = -1
        ordered = np.sort(fresh, axis=1)  # drop repeats within a row
        ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
        at, col = np.nonzero(ordered >= 0)
        seen[rows[at], ordered[at, col]] = True
        found = np.full(ordered.shape, -np.inf, np.float32)
        found[at, col] = np.einsum("ij,ij->i", x[ordered[at, col]], queries[rows[at]])
        all_nodes = np.concatenate([nodes[rows], ordered], axis=1)
        all_sims = np.concatenate([sims[rows], found], axis=1)
        all_open = np.concatenate([open_[rows], ordered >= 0], axis=1)
        best = _first(all_sims, beam)
        nodes[rows] = np.take_along_axis(all_nodes, best, axis=1)
        sims[rows] = np.take_along_axis(all_sims, best, axis=1)
        open_[rows] = np.take_along_axis(all_open, best, axis=1)

    meet(q, entries)
    while True:
        rows = q[open_.any(axis=1)]
        if not len(rows):
            return nodes, sims
        at = open_[rows].argmax(axis=1)  # beams are sorted, so the first open one is the nearest
        open_[rows, at] = False
        meet(rows, graph[nodes[rows, at]])


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` neighbours for each of ``own``: nearest first, dropping candidates that a
    chosen neighbour is nearer to by the factor ``ALPHA``."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    ordered = np.sort(candidates, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    points = x[np.maximum(ordered, 0)]
    sims = np.einsum("ckd,cd->ck", points, x[own])
    sims[ordered < 0] = -np.inf
    best = _first(sims, sims.shape[1])
    ordered, sims = np.take_along_axis(ordered, best, axis=1), np.take_along_axis(sims, best, axis=1)
    points = np.take_along_axis(points, best[:, :, None], axis=1)
    alive = ordered >= 0
    out = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for i in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, i] = ordered[rows, pick][some]
        alive[rows, pick] = False
        between = np.einsum("ckd,cd->ck", points, points[rows, pick])
        # points at the same place, up to rounding, do not replace each other
        alive &= ~((ALPHA * (1 - between) < 1 - sims - 1e-6) & some[:, None])
    return out


def medoids_of(x: np.ndarray) -> np.ndarray:
    """About sqrt(n) nodes, each nearest to the mean of a part of the shard; where searches start."""
    n = len(x)
    k = int(np.ceil(np.sqrt(n)))
    c = x[np.random.default_rng(1).permutation(n)[:k]]
    for _ in range(4):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return np.unique((c @ x.T).argmax(axis=1))


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """``(neighbours of each node, medoids)`` of a shard of unit vectors."""
    n = len(x)
    graph = np.full((n, degree), -1)
    medoids = medoids_of(x)
    order = np.random.default_rng(0).permutation(n)
    order = np.concatenate([medoids, order[~np.isin(order, medoids)]])
    done, step = 1, 1
    while done < n:
        batch = order[done:done + step]
        starts = np.tile(order[:min(done, len(medoids))], (len(batch), 1))
        found, _ = greedy(x, graph, x[batch], starts, beam)
        # members of one batch may be neighbours as well
        mates = batch[_first(x[batch] @ x[batch].T, min(len(batch), beam))]
        graph[batch] = robust_prune(x, batch, np.concatenate([found, mates], axis=1), degree)
        source, column = np.nonzero(graph[batch] >= 0)
        target, source = graph[batch[source], column], batch[source]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        ends, counts = np.unique(target, return_counts=True)
        fresh = np.full((len(ends), counts.max() if len(counts) else 0), -1)
        place = np.arange(len(target)) - np.repeat(np.cumsum(counts) - counts, counts)
        fresh[np.repeat(np.arange(len(ends)), counts), place] = source
        if len(ends):
            graph[ends] = robust_prune(x, ends, np.concatenate([graph[ends], fresh], axis=1), degree)
        done += len(batch)
        step = min(max(1, done), max(32, n // 8))
    return graph, medoids


def both_ways(graph: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(begin, neighbours)``: the neighbours of node i are those from ``begin[i]`` to ``begin[i + 1]``.

    Within a dense group everyone points to its few central nodes; only against the direction of the
    edges can the others be reached from there.
    """
    n = len(graph)
    source, column = np.nonzero(graph >= 0)
    target = graph[source, column]
    pairs = np.unique(np.concatenate([source * n + target, target * n + source]))
    return np.searchsorted(pairs // max(1, n), np.arange(n + 1)), pairs % max(1, n)


def in_range(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, medoids: np.ndarray, beam: int, slack: float) -> np.ndarray:
    """``queries x nodes``: what the search of each query node reaches within ``slack`` of it."""
    begin, neighbours = both_ways(graph)
    tested = np.zeros((len(queries), len(x)), bool)
    reached = np.zeros((len(queries), len(x)), bool)
    starts = np.concatenate([np.tile(medoids, (len(queries), 1)), queries[:, None]], axis=1)
    nodes, _ = greedy(x, graph, x[queries], starts, beam)
    rows, column = np.nonzero(nodes >= 0)
    waiting = [(rows, nodes[rows, column])]
    while waiting:
        rows, fresh = waiting.pop()
        new = ~tested[rows, fresh]
        pairs = np.unique(rows[new] * len(x) + fresh[new])
        rows, fresh = pairs // len(x), pairs % len(x)
        tested[rows, fresh] = True
        keep = np.einsum("ij,ij->i", x[fresh], x[queries[rows]]) >= slack
        rows, fresh = rows[keep], fresh[keep]
        reached[rows, fresh] = True
        sizes = begin[fresh + 1] - begin[fresh]
        ends = np.cumsum(sizes)
        first = 0
        while first < len(fresh):  # expand in blocks of bounded size
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + EXPANSION, "right")))
            own = sizes[first:last]
            flat = np.arange(own.sum()) + np.repeat(begin[fresh[first:last]] - (np.cumsum(own) - own), own)
            far, at = neighbours[flat], np.repeat(rows[first:last], own)
            new = ~tested[at, far]
            if new.any():
                waiting.append((at[new], far[new]))
            first = last
    return reached


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors, scaled first so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- the steps ----------------------------------------------------------------------------------


def _nodes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """``(members, nodes)``: every usable row with the key of its direction, and one node for each key."""
    v = F.col(vec_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN counts as largest
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.transform(v, lambda x: x + F.lit(0.0)).alias("vector")
    )
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    rows = rows.withColumn("way", let(largest, lambda m: F.transform("vector", lambda x: F.rint(x / m * 2.0**40).cast("bigint"))))
    keyed = rows.select(
        "id", F.xxhash64("label", "way").alias("k1"), F.xxhash64(F.lit(1), "way", "label").alias("k2"),
        F.xxhash64("label", F.size("vector")).alias("field"), "vector",
    )
    members = keyed.select("id", "k1", "k2").distinct()
    first = keyed.groupBy("k1", "k2").agg(F.min("id").alias("node"), F.first("field").alias("field"), F.min("vector").alias("vector"))
    copies = members.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    return members, checkpoint(first.join(copies, ["k1", "k2"]))


def _centroids(rows: pd.DataFrame) -> pd.DataFrame:
    """A few rounds of spherical k-means on the sample of one group."""
    x = unit(np.stack(rows.sort_values("node")["vector"].to_numpy()).astype(np.float64))
    k = min(int(rows["k"].iloc[0]), len(x))
    c = x[np.random.default_rng(0).permutation(len(x))[:k]]
    for _ in range(6):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "n": [rows["n"].iloc[0]], "k": [k], "centroids": [c.tobytes()]})


def _shards(nodes: DataFrame, size: int, overlap: int) -> DataFrame:
    """``(shard, node, home, tied, vector)`` with every node in about ``overlap`` shards, at home in one.

    A shard that is too large and holds more than half of the group it was cut from is not cut again: its nodes are
    tied and dealt by a hash, each to one shard. Only the first ``OVERLAP_LEVELS`` cuts multiply rows.
    """
    placed = nodes.select(F.col("field").alias("shard"), F.lit(None).cast("bigint").alias("was"), "node", F.lit(True).alias("home"), "vector")

    def assign(copies: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard, rows in batch.groupby("shard"):
                    k = int(rows["k"].iloc[0])
                    c = np.frombuffer(rows["centroids"].iloc[0]).reshape(k, -1)
                    near = _first(unit(np.stack(rows["vector"].to_numpy())) @ c.T, min(copies, k))
                    for rank in range(near.shape[1]):
                        yield pd.DataFrame({
                            "shard": shard, "was": rows["n"].to_numpy(), "part": near[:, rank], "node": rows["node"].to_numpy(),
                            "home": rows["home"].to_numpy() & (rank == 0), "vector": rows["vector"].to_numpy(),
                        })

        return run

    done = None

    def keep(rows: DataFrame, tied: bool) -> None:
        nonlocal done
        rows = rows.select("shard", "node", "home", F.lit(tied).alias("tied"), "vector")
        done = rows if done is None else done.unionByName(rows)

    for level in range(MAX_LEVELS + 1):
        counts = checkpoint(placed.groupBy("shard").agg(F.count("*").alias("n"), F.max("was").alias("was")))
        keep(placed.join(counts.where(F.col("n") <= 2 * size).select("shard"), "shard"), False)
        large = counts.where(F.col("n") > 2 * size)
        stuck = large.where(F.lit(level == MAX_LEVELS) | (F.col("n") * 2 > F.col("was")))
        large = large.where(F.lit(level < MAX_LEVELS) & F.coalesce(F.col("n") * 2 <= F.col("was"), F.lit(True)))
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / size).cast("bigint"))
        tied = placed.where("home").join(stuck.select("shard", "n"), "shard")
        keep(tied.withColumn("shard", F.xxhash64("shard", part)), True)
        if large.isEmpty():
            break
        k = F.least(F.lit(MAX_CENTROIDS), F.ceil(F.col("n") * overlap / size)).cast("int")
        over = placed.drop("was").join(large.select("shard", "n", k.alias("k")), "shard")
        share = (F.col("k") * SAMPLE_PER_CENTROID) / F.col("n")
        sample = over.where(F.xxhash64("node", "shard").cast("double") / 2.0**64 + 0.5 < share)
        fitted = checkpoint(sample.select("shard", "node", "n", "k", "vector").groupBy("shard").applyInPandas(
            _centroids, "shard bigint, n bigint, k int, centroids binary"
        ))
        cut = placed.drop("was").join(fitted, "shard").mapInPandas(
            assign(overlap if level < OVERLAP_LEVELS else 1),
            "shard bigint, was bigint, part int, node bigint, home boolean, vector array<double>",
        )
        placed = checkpoint(cut.select(F.xxhash64("shard", "part").alias("shard"), "was", "node", "home", "vector"))
    return checkpoint(done)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node", ignore_index=True)
    x = unit(np.stack(rows["vector"].to_numpy())).astype(np.float32)
    ids = rows["node"].to_numpy()
    graph, _ = build(x)
    near = [g[g >= 0] for g in graph]
    return pd.DataFrame({
        "node": ids, "near": [ids[g].tolist() for g in near],
        "close": [ids[g[x[g] @ x[i] >= SLACK]].tolist() for i, g in enumerate(near)],
    })


def _search_shard(threshold: float, beam: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "home"], ignore_index=True)
        ids, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        exact = unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        x = exact.astype(np.float32)
        width = max((len(v) for v in rows["near"]), default=0)
        graph = np.full((len(ids), max(1, width)), -1)
        for i, names in enumerate(rows["near"]):
            names = np.asarray(names, np.int64)
            at = np.minimum(np.searchsorted(ids, names), len(ids) - 1)
            graph[i, :len(names)] = np.where(ids[at] == names, at, -1)
        medoids = medoids_of(x)
        home = np.flatnonzero(rows["home"].to_numpy())
        counts, near = np.zeros((2, len(ids)), np.int64)
        root = np.arange(len(ids))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        position = np.full(len(ids), -1)
        position[home] = np.arange(len(home))
        reached = np.zeros((len(home), len(ids)), bool)
        for start in range(0, len(home), 512):
            part = home[start:start + 512]
            reached[start:start + 512] = in_range(x, graph, part, medoids, beam, SLACK)
        a, b = np.nonzero(reached)
        back = position[b] >= 0  # found from either side
        reached[position[b[back]], home[a[back]]] = True
        a, b = np.nonzero(reached)
        for start in range(0, len(a), 200_000):
            p, q = a[start:start + 200_000], b[start:start + 200_000]
            keep = (np.einsum("ij,ij->i", exact[home[p]], exact[q]) >= threshold) & (home[p] != q)
            p, q = home[p[keep]], q[keep]
            np.add.at(counts, p, copies[q])
            np.add.at(near, p, 1)
            for i, j in zip(p.tolist(), q.tolist(), strict=True):
                i, j = find(i), find(j)
                if i != j:
                    root[max(i, j)] = min(i, j)
        top = np.array([find(i) for i in range(len(ids))])
        linked = np.flatnonzero(top != np.arange(len(ids)))
        return pd.concat([
            pd.DataFrame({
                "node": ids[home], "links": pd.array(counts[home], "Int64"), "other": pd.array([pd.NA] * len(home), "Int64"),
                "dense": near[home] > DEGREE,
            }),
            pd.DataFrame({
                "node": ids[top[linked]], "links": pd.array([pd.NA] * len(linked), "Int64"), "other": pd.array(ids[linked], "Int64"),
                "dense": False,
            }),
        ])

    return run


def _search(nodes: DataFrame, threshold: float, overlap: int, beam: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """``(node, links, other, dense)``, numbers of links (other is NULL) and a forest of links (links is NULL), and the shards."""
    shards = _shards(nodes, shard, overlap)
    built = checkpoint(shards.groupBy("shard").applyInPandas(_build_shard, "node bigint, near array<bigint>, close array<bigint>"))
    united = built.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
        F.array_distinct(F.flatten(F.collect_list("close"))).alias("close"),
    )
    united = checkpoint(united.join(nodes.select("node", "copies", "vector"), "node"))
    places = shards.select("shard", "node", "home")
    far = places.join(united.select("node", "close"), "node").select("shard", F.explode("close").alias("node"), F.lit(False).alias("home"))
    held = places.unionByName(far).groupBy("shard", "node").agg(F.max("home").alias("home"))
    filled = held.join(united.drop("close"), "node")
    found = checkpoint(filled.groupBy("shard").applyInPandas(
        _search_shard(threshold, beam), "node bigint, links bigint, other bigint, dense boolean"
    ))
    return found, shards


# --- exact products -----------------------------------------------------------------------------


class Forest:
    """A spanning forest of the links that a task meets, between queries (places from 0) and the rows of a batch."""

    def __init__(self, queries: int):
        self.queries = queries
        self.label = np.arange(queries)

    def batch(self, rows: int) -> None:
        """Forget the rows of the batch before; queries stay joined."""
        self.label = np.concatenate([self.label[:self.queries], self.queries + np.arange(rows)])

    def _join(self, places: np.ndarray) -> list[tuple[int, int]]:
        labels = np.unique(self.label[places])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]  # the smallest is that of a query
        return [(int(labels[0]), int(x)) for x in labels[1:]]

    def add(self, hit: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> list[tuple[int, int]]:
        """Links that join what was apart, of ``hit`` (rows x queries at these places)."""
        out = []
        waiting = hit.any(axis=1)
        while waiting.any():
            own = np.zeros(len(rows), bool)
            cols = np.zeros(len(queries), bool)
            edge = np.zeros(len(rows), bool)
            edge[waiting.argmax()] = True
            while edge.any():  # every row and column is looked at once
                own |= edge
                waiting &= ~edge
                fresh = hit[edge].any(axis=0) & ~cols
                cols |= fresh
                edge = hit[:, fresh].any(axis=1) & waiting
            out += self._join(np.concatenate([queries[cols], self.queries + rows[own]]))
        return out


def exact_links(queries: pd.DataFrame, threshold: float):
    """Function of batches ``(node, field, copies, vector)``: ``(node, links, other, asked)``.

    ``queries`` has ``node, field, block, copies, vector``. Links of a query (asked) come in parts, one for each task;
    links of a row to queries likewise (not asked). ``other`` closes a forest of links, as in the search.
    """
    queries = queries.sort_values(["field", "block", "node"], ignore_index=True)
    ids, copies = queries["node"].to_numpy(), queries["copies"].to_numpy()
    angle = np.arccos(min(1.0, threshold)) + 1e-6
    blocks: dict[int, list] = {}
    for (field, _), own in queries.groupby(["field", "block"]):
        x = unit(np.stack(own["vector"].to_numpy()).astype(np.float64))
        for start in range(0, len(x), ROWS):
            part = x[start:start + ROWS]
            mean = part.sum(axis=0)
            center = mean / np.linalg.norm(mean) if np.linalg.norm(mean) > 1e-9 else part[0]
            radius = float(np.arccos(np.clip(part @ center, -1, 1)).max())
            blocks.setdefault(field, []).append((own.index.to_numpy()[start:start + ROWS], part, center, min(np.pi, radius + angle)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), np.int64)
        forest = Forest(len(ids))
        for batch in batches:
            for field, rows in batch.groupby("field"):
                if field not in blocks:
                    continue
                nodes, weight = rows["node"].to_numpy(), rows["copies"].to_numpy()
                x = unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
                met = np.zeros(len(nodes), np.int64)
                forest.batch(len(nodes))
                edges = []
                for at, part, center, reach in blocks[field]:
                    near = np.flatnonzero(x @ center >= np.cos(reach) - 1e-9)
                    for start in range(0, len(near), ROWS):
                        own = near[start:start + ROWS]
                        hit = x[own] @ part.T >= threshold
                        hit &= nodes[own][:, None] != ids[at][None, :]
                        some = hit.any(axis=1)
                        if some.any():
                            own, hit = own[some], hit[some]
                            total[at] += weight[own] @ hit
                            met[own] += hit @ copies[at]
                            edges += forest.add(hit, own, at)
                names = np.concatenate([ids, nodes])
                a, b = np.array(edges, np.int64).reshape(-1, 2).T
                yield pd.DataFrame({"node": names[a], "links": pd.array([pd.NA] * len(a), "Int64"), "other": pd.array(names[b], "Int64"), "asked": False})
                some = np.flatnonzero(met)
                yield pd.DataFrame({"node": nodes[some], "links": pd.array(met[some], "Int64"), "other": pd.array([pd.NA] * len(some), "Int64"), "asked": False})
        some = np.flatnonzero(total)
        yield pd.DataFrame({"node": ids[some], "links": pd.array(total[some], "Int64"), "other": pd.array([pd.NA] * len(some), "Int64"), "asked": True})

    return run


def _chunks(todo: DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of ``todo`` (block, size, ...) in pieces of about ``CHUNK_BYTES``, whole blocks together where they fit."""
    per_row = 8 * (todo.agg(F.max(F.size("vector"))).first()[0] or 1)
    most = max(1, CHUNK_BYTES // per_row)
    sizes = todo.groupBy("block").agg(F.ceil(F.count("*") / most).cast("bigint").alias("pieces"))
    piece = F.pmod(F.xxhash64(F.lit(3), "node"), "pieces")
    todo = checkpoint(todo.join(sizes, "block").withColumn("block", F.xxhash64("block", piece)).drop("pieces"))
    blocks, held = [], 0
    for r in todo.groupBy("block").count().orderBy("block").toLocalIterator():
        if blocks and held + r["count"] > most:
            yield todo.where(F.col("block").isin(blocks)).toPandas()
            blocks, held = [], 0
        blocks.append(r["block"])
        held += r["count"]
    if blocks:
        yield todo.where(F.col("block").isin(blocks)).toPandas()


def finish(nodes: DataFrame, found: DataFrame, todo: DataFrame, threshold: float) -> DataFrame:
    """``found`` with exact numbers of links for the nodes of ``todo`` (node, block), and for those whose links to these
    alone are more than the search had found, until there are none."""
    rows = nodes.select("node", "field", "copies", "vector")
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    counts = counts.withColumns({"met": F.lit(0).cast("bigint"), "done": F.lit(False)})
    forest = found.where("other IS NOT NULL").select("node", "other")
    todo = checkpoint(todo)
    if todo.isEmpty():
        return found
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    rows = checkpoint(rows.repartition(parts, "node"))
    while not todo.isEmpty():
        asked = checkpoint(todo.join(rows, "node"))
        pieces = []
        for queries in _chunks(asked):
            links = rows.mapInPandas(exact_links(queries, threshold), "node bigint, links bigint, other bigint, asked boolean")
            pieces.append(checkpoint(links.groupBy("node", "other", "asked").agg(F.sum("links").alias("links"))))
        got = functools.reduce(DataFrame.unionByName, pieces)
        forest = forest.unionByName(got.where("other IS NOT NULL").select("node", "other"))
        sums = got.where("other IS NULL").groupBy("node").agg(
            F.sum(F.when(F.col("asked"), F.col("links"))).alias("exact"), F.sum(F.when(~F.col("asked"), F.col("links"))).alias("more")
        )
        now = todo.select("node", F.lit(True).alias("now"))
        counts = counts.join(sums, "node", "left").join(now, "node", "left")
        counts = checkpoint(counts.select(
            "node", F.when(F.col("now"), F.coalesce("exact", F.lit(0))).otherwise(F.col("links")).alias("links"),
            (F.col("met") + F.coalesce("more", F.lit(0))).alias("met"), (F.col("done") | F.col("now").isNotNull()).alias("done"),
        ))
        # rows near queries, but with fewer links than these are: their search was cut off as well
        short = counts.where("NOT done AND met > links").select("node")
        todo = checkpoint(short.join(rows.select("node", F.col("field").alias("block")), "node"))
    return checkpoint(counts.select("node", "links", F.lit(None).cast("bigint").alias("other")).unionByName(
        forest.select("node", F.lit(None).cast("bigint").alias("links"), "other")
    ))


def audit(nodes: DataFrame, threshold: float, queries: int = AUDIT, linked: DataFrame | None = None) -> DataFrame:
    """``(node, truth)`` of at most ``queries`` nodes by hash order, and as many of ``linked`` (node), by comparison with all
    nodes of their label."""
    def first(of: DataFrame) -> pd.DataFrame:
        return of.orderBy(F.xxhash64("node")).limit(queries).select("node", "field", "vector").toPandas()

    asked = first(nodes)
    if linked is not None:
        asked = pd.concat([asked, first(nodes.join(linked, "node"))]).drop_duplicates("node", ignore_index=True)
    by_field = {k: (g["node"].to_numpy(), unit(np.stack(g["vector"].to_numpy()))) for k, g in asked.groupby("field")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for field, rows in batch.groupby("field"):
                if field in by_field:
                    ids, q = by_field[field]
                    hit = unit(np.stack(rows["vector"].to_numpy())) @ q.T >= threshold
                    hit &= rows["node"].to_numpy()[:, None] != ids[None, :]
                    yield pd.DataFrame({"node": ids, "truth": rows["copies"].to_numpy() @ hit})

    found = nodes.select("node", "field", "copies", "vector").mapInPandas(run, "node bigint, truth bigint")
    return found.groupBy("node").agg(F.sum("truth").alias("truth"))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, shard: int = SHARD, overlap: int = OVERLAP, beam: int = BEAM, min_recall: float = MIN_RECALL,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    members, nodes = _nodes(vectors, id_col, vec_col, label_col)
    truth = None
    for attempt in range(ATTEMPTS):
        found, shards = _search(nodes, threshold, overlap + attempt, beam << attempt, shard)
        own = found.where("other IS NULL").select("node", "links", "dense")
        homes = checkpoint(shards.where("home").select("node", "tied", F.col("shard").alias("block")).join(own, "node"))
        rest = homes.where("NOT tied AND NOT dense").select("node", "links")
        if truth is None:
            truth = checkpoint(audit(nodes, threshold, linked=rest.where("links > 0").select("node")))
        total = truth.join(rest, "node").agg(F.sum(F.least("links", "truth")).alias("found"), F.sum("truth").alias("all")).first()
        recall = (total["found"] or 0) / total["all"] if total["all"] else 1.0
        if recall >= min_recall:
            todo = homes.where("tied OR dense")
            break
    else:
        todo = homes
    found = finish(nodes, found, todo.select("node", "block"), threshold)
    label = components(found.where("other IS NOT NULL"), "node", "other")
    info = nodes.join(found.where("other IS NULL").select("node", "links"), "node", "left").join(label, "node", "left")
    info = checkpoint(info.select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    ))
    known = members.join(info, ["k1", "k2"]).groupBy("id").agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    rows = vectors.select(F.col(id_col)).join(known, F.col(id_col) == F.col("id"), "left")
    component = F.coalesce("component_id", F.col(id_col))
    return rows.select(
        id_col, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.cast("bigint").alias("component_id"),
        (F.col(id_col) == component).alias("kept"),
    )
