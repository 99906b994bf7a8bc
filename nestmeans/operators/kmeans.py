"""K-means over a whole table or inside every group of it.

``fit_groups`` trains one model per group; a plain fit is the case of a single group. Each
group takes one of three ways, which give the same result (see ``spaces``):

* local - the training rows of a group are few: one grouped-map task trains it, all groups in
  parallel, no Spark job per iteration;
* broadcast - the group is large but the models of all large groups fit the broadcast budget:
  every iteration is a map over the cached training rows with one partial sum per cluster and
  task, merged by a small shuffle;
  More models than that are dealt into a few rounds of this kind;
* streamed - the model of a group, or too many models, do not fit: rows are cut into slices, as many as memory needs,
  and slices are put together to parts, as many as share the work. Every part meets the centroids of its group in one
  sorted partition. The task keeps them in a temporary file and reads it for every slice, so it
  holds one slice and one batch of centroids, whatever their number, and centroids are copied to parts only.

Assignment of all rows to a trained model has the last two ways, and deals models into rounds as well.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from nestmeans.functions.vectors import HASH_BITS, hash_order
from nestmeans.operators import bounds, kernels, limbs, packed, spaces, training
from nestmeans.operators.spaces import Space, space_of
from nestmeans.options import KMeansOptions
from nestmeans.schemas import CENTROIDS, payload_bytes, require_columns
from nestmeans.scratch import checkpoint, settle, store

G, ID, H = "_g", "_id", "_h"
_SPAN = 1 << HASH_BITS
_LOCAL_PLAN_ROWS = 100_000
_LOCAL_MODEL_BYTES = 16 << 20
_RANK_ROWS = 100_000
_OUT_ROWS = 10_000
_TASK_FLOPS = 1e9
_CELL_FLOPS = 1e10
_CELL_TASKS = 200_000
_LEAST_PARTS = 8
_SPOOL_BYTES = 8 << 20
_MERGE_BYTES = 32 << 20
_ROUNDS = 16
# A model that is broadcast passes through the driver, which holds it several times over: its starts, the last and the
# next pass, and what is sent.
_DRIVER_MODEL_BYTES = 32 << 20

# ``at`` is the position of the row's centre in the model, -1 before the first pass, ``low`` the bound
# of its distance to all others.
_PACKED = "_g bigint, grid binary, at int, low float"
# One limb of a cluster's vector sum; without a ``total`` its row count (limb _COUNT) or, as cluster
# _COST, one limb of the group's sum of distances, in ``n``.
_PARTIAL = "_g bigint, cluster int, limb int, n bigint, total array<bigint>"
_COUNT, _COST = -(1 << 20), -1


def model_ddl(space: Space) -> str:
    return f"_g bigint, cluster int, grid array<{space.element}>, n bigint, objective double"


def _mean_ddl(space: Space) -> str:
    return f"_g bigint, cluster int, n bigint, cost double, mean array<{space.element}>"


# --- public operators -----------------------------------------------------------------------


def kmeans_fit(
    df: DataFrame,
    k: int,
    vec: str = "fp",
    row_id: str = "row_id",
    options: KMeansOptions = KMeansOptions(),
) -> DataFrame:
    """Train k centroids; k is clamped to the number of rows. See ``schemas.CENTROIDS``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    require_columns(df, vec, row_id)
    spark = df.sparkSession
    n, dim = vector_facts(df, vec)
    if not n:
        return spark.createDataFrame([], CENTROIDS)
    space = space_of(options.scale, element_of(df, vec))
    rows = training_rows(df, vec, row_id, F.lit(0), options)
    plans = make_plans(single_sizes(spark, n, k), dim, options, whole=False)
    return public_model(fit_groups(rows, plans, dim, space, options), options).drop(G)


def kmeans_assign(
    df: DataFrame,
    centroids: DataFrame,
    vec: str = "fp",
    options: KMeansOptions = KMeansOptions(),
    row_id: str = "row_id",
    cluster_col: str = "cluster",
    dist_col: str = "dist",
) -> DataFrame:
    """Nearest centroid of every row and the squared distance to it.

    ``centroids`` needs ``cluster`` and ``centroid``. Rows do not move while the centroids fit
    the broadcast budget; on a streaming ``df`` they have to.
    """
    require_columns(df, vec)
    _, dim = vector_facts(centroids, "centroid")
    out = T.StructType(
        df.schema.fields
        + [T.StructField(cluster_col, T.IntegerType()), T.StructField(dist_col, T.DoubleType())]
    )
    if dim is None:
        if df.isStreaming or not df.isEmpty():
            raise ValueError("no centroids to assign to")
        return df.sparkSession.createDataFrame([], out)
    space = space_of(options.scale, element_of(df, vec))
    model = centroids.select(
        F.lit(0).cast("bigint").alias(G),
        F.col("cluster").cast("int"),
        space.column("centroid").alias("grid"),
    )
    return assign_groups(df, model, vec, F.lit(0), row_id, dim, space, options, out)


# --- plans: how many centroids, how many training rows, which way -----------------------------


def vector_facts(df: DataFrame, vec: str) -> tuple[int, int | None]:
    """(rows, width of the vectors or None), in one pass that reads no element."""
    size = F.size(vec)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("least"), F.max(size).alias("most")).first()
    if row.n and (row.least is None or row.least < 1 or row.least != row.most):
        raise ValueError(f"every vector needs the same number of elements: {vec} holds a NULL, an empty one or several widths")
    return row.n, row.most if row.n else None


def element_of(df: DataFrame, vec: str) -> str:
    return df.schema[vec].dataType.elementType.simpleString()


def training_rows(df, vec, row_id, group, options) -> DataFrame:
    """(group, row id, one order hash per restart, vector): all that training reads."""
    hashes = [hash_order(row_id, options.seed + r) for r in range(options.n_init)]
    return df.select(
        group.cast("bigint").alias(G),
        F.col(row_id).cast("bigint").alias(ID),
        F.array(*hashes).alias(H),
        F.col(vec).alias("vec"),
    )


def group_plan(sizes: DataFrame, dim: int, options: KMeansOptions, whole: bool) -> DataFrame:
    """Complete (group, n, k, bytes) with the sample cuts, and what a local task would hold and do.

    ``bytes`` is what the rows of the group carry besides their vectors.

    A group of n rows trains on all of them, or with ``max_points_per_centroid`` on the rows with
    a hash below the cut, about that many for each centroid. ``whole`` says
    that a local task gets all rows of the group and not only the sample.
    """
    n, k = F.col("n"), F.col("k")
    limit = options.max_points_per_centroid
    cap = n if limit is None else k.cast("bigint") * F.lit(limit)
    m = F.least(n, cap)

    def share(wanted):
        part = F.floor(F.lit(float(_SPAN)) * (wanted.cast("double") / n.cast("double")))
        return F.least(part, F.lit(_SPAN)).cast("bigint")

    def ample(wanted):
        return wanted + F.sqrt(wanted.cast("double")) * 40 + 1000

    # the Arrow column, the grid copy, the chosen rows and the work space of a task
    held = (n if whole else F.least(n, ample(m))) * F.lit(float(dim * 8 * 4)) + F.col("bytes")
    flops = m.cast("double") * k * F.lit(2.0 * dim * options.max_iter * options.n_init)
    return sizes.select(
        G, n, k,
        F.when(n > cap, share(cap)).otherwise(F.lit(_SPAN)).alias("cut"),
        share(ample(m)).alias("sample_cut"),
        share(ample(k)).alias("start_cut"),
        m.cast("double").alias("m"),
        held.alias("held"),
        flops.alias("flops"),
    )


@dataclass(frozen=True)
class Plan:
    """The groups that go one way, and the sums that size the job."""

    frame: DataFrame
    groups: int
    rows: float
    centers: int
    flops: float
    max_k: int
    null_groups: int
    table: pa.Table | None = None  # the groups themselves, where they are few


def make_plans(sizes: DataFrame, dim: int, options: KMeansOptions, whole: bool):
    """(local plan, large plan) of the groups in ``sizes``; computes the group sizes now."""
    spark = sizes.sparkSession
    plan = group_plan(sizes, dim, options, whole)
    head = plan.limit(_LOCAL_PLAN_ROWS + 1).toArrow()
    # A lone group should use the cluster; with a group for every core, one task each does.
    share = min(1.0, max(0.05, head.num_rows / parallelism(spark)))
    flops = options.local_flops * share
    if head.num_rows > _LOCAL_PLAN_ROWS:
        fits = (F.col("held") <= options.local_bytes) & (F.col("flops") <= flops)
        plan = checkpoint(plan)
        return _stored_plan(plan.filter(fits)), _stored_plan(plan.filter(~fits))
    fits = (head["held"].to_numpy() <= options.local_bytes) & (head["flops"].to_numpy() <= flops)
    return tuple(_local_plan(spark, head.filter(pa.array(w)), plan.schema) for w in (fits, ~fits))


def _local_plan(spark: SparkSession, part: pa.Table, schema: T.StructType) -> Plan:
    m, k = part["m"].to_numpy(), part["k"].to_numpy()
    return Plan(
        spark.createDataFrame(part, schema=schema), len(m), float(m.sum()), int(k.sum()),
        float((m * k).sum()), int(k.max(initial=0)), part[G].null_count, part,
    )


def _stored_plan(part: DataFrame) -> Plan:
    facts = part.agg(
        F.count(F.lit(1)), F.sum("m"), F.sum("k"), F.sum(F.col("m") * F.col("k")), F.max("k"),
        F.count_if(F.col(G).isNull()),
    ).first()
    return Plan(part, *(fact or 0 for fact in facts))


def single_sizes(spark: SparkSession, n: int, k: int) -> DataFrame:
    return spark.createDataFrame(pa.table({G: [0], "n": [n], "k": [min(k, n)], "bytes": [0]}))


def attach(rows: DataFrame, facts: DataFrame, *columns: str) -> DataFrame:
    """Keep the rows of the groups in ``facts`` and add its columns.

    The facts of a single group become literals, which needs no join.
    """
    facts = facts.select(G, *columns)
    head = facts.limit(2).collect()
    if len(head) != 1:
        return rows.join(facts, G)
    types = facts.schema
    literals = {c: F.lit(head[0][c]).cast(types[c].dataType) for c in columns}
    return rows.filter(F.col(G) == head[0][G]).withColumns(literals)


def _settle_model(df: DataFrame, dim: int) -> DataFrame:
    return settle(df, _LOCAL_MODEL_BYTES // (8 * dim))


def public_model(model: DataFrame, options: KMeansOptions) -> DataFrame:
    """Grid integers back to coordinates, the objective back to squared distance."""
    if options.scale is None:
        return model.withColumnRenamed("grid", "centroid")
    scale = float(options.scale)
    return model.select(
        G,
        "cluster",
        F.transform("grid", lambda x: x / F.lit(scale)).alias("centroid"),
        "n",
        (F.col("objective") / F.lit(scale * scale)).alias("objective"),
    )


def parallelism(spark: SparkSession) -> int:
    return max(
        spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )


def _tasks(spark: SparkSession, work: float = 0, memory: float = 0) -> int:
    """Tasks for ``work``, at most a few waves of the cluster, and as many as ``memory`` needs."""
    waves = min(np.ceil(work), 4 * parallelism(spark))
    return int(max(1, waves, np.ceil(memory)))


# --- training ---------------------------------------------------------------------------------


def fit_groups(
    rows: DataFrame, plans: tuple[Plan, Plan], dim: int, space: Space, options: KMeansOptions
) -> DataFrame:
    """One model per planned group: (_g, cluster, grid, n, objective), computed."""
    local, large = plans
    models = []
    if local.groups:
        models.append(_settle_model(_fit_local(rows, local, dim, space, options), dim))
    if large.groups:
        models.append(fit_large(rows, large, dim, space, options))
    if not models:
        return rows.sparkSession.createDataFrame([], model_ddl(space))
    return models[0] if len(models) == 1 else models[0].unionByName(models[1])


def fit_large(rows: DataFrame, plan: Plan, dim: int, space: Space, options: KMeansOptions) -> DataFrame:
    """Models of groups beyond one task: in broadcast rounds as far as they go, streamed beyond."""
    sent = replace(options, broadcast_bytes=min(options.broadcast_bytes, _DRIVER_MODEL_BYTES))
    rounds, streamed = broadcast_rounds(rows.sparkSession, plan, dim, sent)
    models = [_fit_broadcast(rows, part, dim, space, options) for part in rounds]
    if streamed is not None:
        models.append(_fit_streamed(rows, streamed, dim, space, options))
    return reduce(DataFrame.unionByName, models)


def broadcast_rounds(spark: SparkSession, plan: Plan, dim: int, options: KMeansOptions) -> tuple[list[Plan], Plan | None]:
    """The groups dealt into at most ``_ROUNDS`` rounds whose models fit the broadcast budget, and the rest.

    Largest models first, each into the first round with room. Groups beyond the budget, those that no round has room
    for, and plans of more than ``_LOCAL_PLAN_ROWS`` groups that do not fit one round are streamed. Every way gives
    the same models, so this decides the time only: a round reads the rows once more.
    """
    budget = options.broadcast_bytes // (8 * dim)
    if plan.centers <= budget:
        return [plan], None
    if plan.table is None:
        return [], plan
    dealt = _dealt(plan.table, budget)
    parts = [plan.table.filter(pa.array(dealt == r)) for r in range(_ROUNDS + 1)]
    plans = [_local_plan(spark, part, plan.frame.schema) if part.num_rows else None for part in parts]
    return [p for p in plans[:-1] if p is not None], plans[-1]


def _dealt(table: pa.Table, budget: int) -> np.ndarray:
    """The round of every group of ``table`` by its number ``k`` of centroids; ``_ROUNDS`` for those without one."""
    k = table["k"].to_numpy()
    order = np.lexsort((table[G].to_numpy(zero_copy_only=False), -k))
    room, dealt = np.full(_ROUNDS, budget, dtype=np.int64), np.full(len(k), _ROUNDS)
    for i in order[np.searchsorted(-k[order], -budget):]:
        free = np.flatnonzero(room >= k[i])
        if len(free):
            dealt[i] = free[0]
            room[free[0]] -= k[i]
    return dealt


def _fit_local(rows, plan: Plan, dim, space: Space, options) -> DataFrame:
    sample = attach(rows, plan.frame, "k", "cut", "sample_cut")
    sample = sample.filter(F.exists(H, lambda h: h < F.col("sample_cut"))).drop("sample_cut")
    tasks = _tasks(rows.sparkSession, plan.groups)
    return (
        sample.repartition(tasks, G)
        .groupBy(G)
        .applyInArrow(local_trainer(dim, space, options.max_iter), model_ddl(space))
    )


def _group_inputs(table: pa.Table, vec: str, dim: int, space: Space):
    x = space.load(kernels.matrix(table[vec], dim))
    hashes = table[H].combine_chunks()
    hashes = hashes.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
    ids = table[ID].to_numpy()
    k, cut = table["k"][0].as_py(), table["cut"][0].as_py()
    if len(x) < k:
        raise ValueError(f"{len(x)} sampled rows cannot start {k} clusters")
    return x, k, hashes, ids, cut


def _lists(a: np.ndarray, kind: str) -> pa.Array:
    """Rows as lists of ``kind``: int, bigint or double."""
    offsets = np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]
    kinds = {"int": np.int32, "bigint": np.int64, "double": np.float64}
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(a.ravel().astype(kinds[kind])))


def local_trainer(dim: int, space: Space, max_iter: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        x, k, hashes, ids, cut = _group_inputs(table, "vec", dim, space)
        centers, sizes, objective = training.train(space, x, k, hashes, ids, cut, max_iter)
        return pa.table({
            G: pa.array(np.full(k, table[G][0].as_py(), dtype=np.int64)),
            "cluster": pa.array(np.arange(k, dtype=np.int32)),
            "grid": _lists(centers, space.element),
            "n": pa.array(sizes),
            "objective": pa.array(np.full(k, objective)),
        })

    return run


def _ranked(df: DataFrame, within: list, bucket: list[str] | None = None, before=None) -> DataFrame:
    """Add ``rank`` 1.. by ``within`` inside every group.

    With ``bucket`` columns a task sorts one bucket only. Buckets follow each other by ``before``,
    and the counts of the earlier ones give each bucket its first rank.
    """
    if not bucket:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(G).orderBy(*within)))
    earlier = Window.partitionBy(G).orderBy(*before).rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(G, *bucket).count().select(
        G, *bucket, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("skip")
    )
    place = F.row_number().over(Window.partitionBy(G, *bucket).orderBy(*within))
    ranked = df.join(offsets, [G, *bucket]).withColumn("rank", place + F.col("skip"))
    return ranked.drop("skip", *bucket)


def _start_rows(rows, plan: Plan, restart: int, space: Space) -> DataFrame:
    """(_g, cluster, grid, h): the k rows of lowest hash of every group, ids in hash order.

    Only rows below a generous cut are ranked; with a large k, in hash ranges.
    """
    candidates = attach(rows, plan.frame, "k", "start_cut").select(
        G, F.col(H)[restart].alias("h"), ID, "vec", "k", "start_cut"
    ).filter("h < start_cut")
    if plan.max_k <= _RANK_ROWS:
        ranked = _ranked(candidates, ["h", ID])
    else:
        width = F.greatest(F.col("start_cut") / F.ceil(F.col("k") / F.lit(_RANK_ROWS)), F.lit(1))
        ranges = candidates.withColumn("range", F.floor(F.col("h") / width))
        ranked = _ranked(ranges, ["h", ID], ["range"], ["range"])
    return ranked.filter("rank <= k").select(
        G,
        (F.col("rank") - 1).cast("int").alias("cluster"),
        space.column("vec").alias("grid"),
        "h",
    )


def _check_starts(found: int, plan: Plan) -> None:
    if found != plan.centers:
        raise ValueError(f"found {found} starting rows, expected {plan.centers}")


def _sample(rows, plan: Plan, last: DataFrame, restart: int) -> DataFrame:
    """Training rows of one restart: hash below the cut, the starting rows in any case, ``last`` of which by hash
    is given for every group."""
    cuts = plan.frame.select(G, "cut").join(last, G).select(
        G, F.greatest("cut", F.col("last") + 1).alias("cut")
    )
    cuts = settle(cuts, _LOCAL_PLAN_ROWS)
    return attach(rows, cuts, "cut").filter(F.col(H)[restart] < F.col("cut"))


class Model:
    """Centroids of several groups as one matrix, sorted by group and cluster. On a grid they are held as the integers
    they are, half the size of the doubles that a search works on."""

    def __init__(self, groups: np.ndarray, clusters: np.ndarray, centers: np.ndarray, space: Space, drift: np.ndarray | None = None):
        self.space, self.drift = space, drift  # how far each centre came from its last place, if it moved
        order = np.lexsort((clusters, groups))
        self.groups, self.clusters = groups[order], clusters[order]
        self.centers = centers if (order[1:] > order[:-1]).all() else centers[order]
        starts = kernels.run_starts(self.groups)
        self.spans = {
            int(self.groups[a]): slice(int(a), int(b)) for a, b in zip(starts, starts[1:])
        }
        self.names = np.array(list(self.spans), dtype=np.int64)
        self.ready: dict[int, object] = {}

    def __getstate__(self):
        return {**self.__dict__, "ready": {}}

    @classmethod
    def of(cls, t: pa.Table, dim: int, space: Space) -> Model:
        centers = kernels.matrix(t["grid"], dim).astype(np.int32 if space.element == "int" else np.float64)
        return cls(t[G].to_numpy(), t["cluster"].to_numpy(), centers, space)

    def doubles(self, span: slice) -> np.ndarray:
        return self.centers[span].astype(np.float64)

    def _by_group(self, groups: np.ndarray):
        """(rows, span of the group's centroids) of every group that occurs."""
        order = np.argsort(groups, kind="stable")
        starts = kernels.run_starts(groups[order])
        for a, b in zip(starts, starts[1:]):
            rows = order[a:b]
            span = self.spans.get(int(groups[rows[0]]))
            if span is None:
                raise ValueError(f"group {groups[rows[0]]} has no centroids")
            yield rows, span

    def update(self, groups: np.ndarray, x: np.ndarray, at: np.ndarray, low: np.ndarray):
        """(positions, distances, bounds, distances measured) from the positions and bounds of the last pass."""
        at, low, dist, measured = at.astype(np.int64), low.astype(np.float64), np.zeros(len(x)), 0
        for rows, span in self._by_group(groups):
            search = self.ready.get(span.start)
            if search is None:
                drift = None if self.drift is None else self.drift[span]
                search = self.ready[span.start] = bounds.Search(self.space, self.doubles(span), drift)
            k = span.stop - span.start
            if self.drift is None:
                found, dist[rows], low[rows] = search.full(x[rows])
                measured += len(rows) * k
            else:
                found, dist[rows], low[rows], more = search.update(x[rows], at[rows] - span.start, low[rows])
                measured += len(rows) + more
            at[rows] = found + span.start
        return at, dist, low, measured

    def nearest(self, groups: np.ndarray, x: np.ndarray):
        """Position in the matrix of the nearest centroid of the row's group, and distance."""
        at, dist = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        for rows, span in self._by_group(groups):
            ready = self.ready.get(span.start)
            if ready is None:  # once in a worker, not once for every batch
                ready = self.ready[span.start] = self.space.prepare(self.doubles(span))
            index, found = self.space.nearest(x[rows], ready)
            at[rows], dist[rows] = index + span.start, found
        return at, dist


def _fit_broadcast(rows, plan: Plan, dim, space: Space, options) -> DataFrame:
    spark = rows.sparkSession
    work, memory = 2 * dim / _TASK_FLOPS, dim * 8 / options.slice_bytes
    tasks = _tasks(spark, plan.flops * work, plan.rows * memory)
    # Rows of a group stay together as far as the work allows, so that a task sends partial sums
    # of a few groups only. Four slices per task even out what hashing puts together.
    work *= 4 * min(1.0, tasks / max(plan.flops * work, 1.0))
    m, k = F.col("m"), F.col("k")
    slices = F.greatest(F.ceil(m * k * F.lit(work)), F.ceil(m * F.lit(4 * memory)), F.lit(1))
    slices = plan.frame.select(G, slices.cast("int").alias("slices"))
    best: dict[int, tuple] = {}
    for restart in range(options.n_init):
        starts = _start_rows(rows, plan, restart, space)
        starts = starts.toArrow()
        model = Model.of(starts, dim, space)
        _check_starts(len(model.centers), plan)
        last = starts.select([G, "h"]).group_by(G).aggregate([("h", "max")]).rename_columns([G, "last"])
        del starts
        sample = _sample(rows, plan, spark.createDataFrame(last), restart).select(G, ID, "vec")
        # packed before they move: rows of zeros and ones are shuffled and cached as bits
        sample = packed.packed_rows(attach(sample, slices, "slices"), "vec", dim, space, "grid").repartition(
            tasks, G, F.pmod(F.xxhash64(ID), F.col("slices"))
        )
        sample = sample.select(G, "grid", F.lit(-1).cast("int").alias("at"), F.lit(0).cast("float").alias("low"))
        sample = sample.persist(StorageLevel.MEMORY_AND_DISK)
        rows_now, done = sample, []
        for turn in range(options.max_iter):
            split = turn + 1 < options.max_iter or space.split_last
            done.append(_broadcast_pass(spark, rows_now, model, dim, tasks, split))
            model, rows_now = done[-1].model, done[-1].rows
            if turn:
                done[-2] = replace(done[-2], model=None)
                if done[-2].stored is not None:
                    done[-2].stored.unpersist()
            if not done[-1].moved:
                break
        if done[-1].stored is not None:
            done[-1].stored.unpersist()
        sample.unpersist()
        for p in done:
            p.sent.destroy()
        sizes, cost = done[-1].sizes, done[-1].cost
        for g, span in model.spans.items():
            if g not in best or cost[g] < best[g][2]:
                best[g] = (model.centers[span], sizes[span], cost[g])
    frame = _model_frame(spark, best, space)
    return frame if plan.centers * dim * 8 <= _LOCAL_MODEL_BYTES else checkpoint(frame)


class _Partial:
    """What a task sends: rows, vector sums and distances of its rows, per centre of a model."""

    def __init__(self, space: Space):
        self.space, self.counts = space, None
        self.sums: dict[int, np.ndarray] = {}
        self.costs: dict[int, np.ndarray] = {}

    def add(self, x: np.ndarray, at: np.ndarray, dist: np.ndarray, owner: np.ndarray, centers: int, groups: int) -> None:
        """Rows with the position of their centre and of their group."""
        if self.counts is None:
            self.counts = np.zeros(centers, dtype=np.int64)
        ids, counts, sums = spaces.cluster_sums(self.space, x, at)
        self.counts[ids] += counts
        for limb, part in sums.items():
            self.sums.setdefault(limb, np.zeros((centers, x.shape[1]), dtype=np.int64))[ids] += part
        self.costs.setdefault(0, np.zeros(groups, dtype=np.int64))  # a sum of zero is told as well
        for limb, part in limbs.grouped_sums(dist[:, None], owner, groups).items():
            self.costs.setdefault(limb, np.zeros(groups, dtype=np.int64))[:] += part[:, 0]

    def batches(self, groups: np.ndarray, clusters: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.counts is None:
            return
        used = np.flatnonzero(self.counts)
        yield _scalars(groups[used], clusters[used], np.full(len(used), _COUNT), self.counts[used])
        for limb, part in self.costs.items():
            yield _scalars(names, np.full(len(names), _COST), np.full(len(names), limb), part)
        for limb, part in self.sums.items():
            some = np.flatnonzero(part.any(axis=1))
            yield _vectors(groups[some], clusters[some], np.full(len(some), limb), part[some])


def _broadcast_pass(spark, rows, model: Model, dim, tasks: int, split: bool):
    """(rows with their new bounds, model, whether it moved, rows per centre, cost per group); ``split`` says
    whether empty clusters are filled."""
    sent = spark.sparkContext.broadcast(model)
    space = model.space
    bounded = max(s.stop - s.start for s in model.spans.values()) >= bounds.LEAST_CENTERS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, found = sent.value, _Partial(space)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, groups = packed.unpack(batch["grid"], dim, space), batch[G].to_numpy()
            if bounded:
                at, dist, low, _ = m.update(groups, x, batch["at"].to_numpy(), batch["low"].to_numpy())
                kept = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
                yield _with_partials({
                    G: batch[G], "grid": batch["grid"], "at": pa.array(at.astype(np.int32)),
                    "low": pa.array(np.where(np.isinf(low), np.float32(np.inf), kept)),
                })
            else:
                at, dist = m.nearest(groups, x)
            found.add(x, at, dist, np.searchsorted(m.names, groups), len(m.centers), len(m.names))
        for batch in found.batches(m.groups, m.clusters, m.names):
            yield _with_partials({n: batch[n] for n in batch.schema.names}) if bounded else batch

    if bounded:
        both = rows.mapInArrow(partial, _STATE)
        both = both.persist(StorageLevel.MEMORY_AND_DISK)
        rows = both.filter("grid IS NOT NULL").select(G, "grid", "at", "low")
        partials = both.filter("grid IS NULL").select(G, "cluster", "limb", "n", "total")
    else:
        both, partials = None, rows.mapInArrow(partial, _PARTIAL)
    merged = _merge(partials, len(model.centers), dim, tasks, space).toArrow()
    whole = merged["cluster"].to_numpy() == _COST
    costs, merged = merged.filter(pa.array(whole)), merged.filter(pa.array(~whole))
    firsts = np.array([span.start for span in model.spans.values()])
    at = firsts[np.searchsorted(model.names, merged[G].to_numpy())] + merged["cluster"].to_numpy()
    centers, sizes = model.centers.copy(), np.zeros(len(model.centers), dtype=np.int64)
    centers[at] = kernels.matrix(merged["mean"], dim)
    sizes[at] = merged["n"].to_numpy()
    if split:
        for g in np.unique(model.groups[sizes == 0]):
            span = model.spans[int(g)]
            centers[span] = kernels.refill(centers[span].astype(np.float64), sizes[span], space.steps)
    cost = dict.fromkeys(model.spans, 0.0) | dict(zip(costs[G].to_pylist(), costs["cost"].to_pylist()))
    moved = not np.array_equal(centers, model.centers)
    drift = _moves(model.centers, centers) if bounded else None
    return _Pass(rows, both, sent, Model(model.groups, model.clusters, centers, space, drift), moved, sizes, cost)


def _moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``bounds.moves`` in doubles, of some centres at a time."""
    parts = [slice(a, a + _OUT_ROWS) for a in range(0, len(old), _OUT_ROWS)]
    return np.concatenate([bounds.moves(old[p].astype(np.float64), new[p].astype(np.float64)) for p in parts])


_STATE = f"{_PACKED}, {_PARTIAL.removeprefix('_g bigint, ')}"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "float": pa.float32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _with_partials(columns: dict) -> pa.RecordBatch:
    """A batch of rows or of partial sums in the common layout, NULL elsewhere."""
    n = len(columns[G])
    fields = (field.split() for field in _STATE.split(", "))
    return pa.record_batch({name: columns[name] if name in columns else pa.nulls(n, _ARROW[kind]) for name, kind in fields})


@dataclass(frozen=True)
class _Pass:
    """What a pass leaves. ``stored`` and ``sent`` are kept while rows are derived from them: lost partitions are made
    again from the cached rows of the first pass and the models of all."""

    rows: DataFrame
    stored: DataFrame | None
    sent: object
    model: Model | None  # of the last pass only
    moved: bool
    sizes: np.ndarray
    cost: dict


def _scalars(groups, clusters, limb, n) -> pa.RecordBatch:
    return _vectors(groups, clusters, limb, np.zeros((len(groups), 0), dtype=np.int64), n)


def _vectors(groups, clusters, limb, total, n=None) -> pa.RecordBatch:
    return pa.record_batch({
        G: pa.array(groups.astype(np.int64)),
        "cluster": pa.array(clusters.astype(np.int32)),
        "limb": pa.array(limb.astype(np.int32)),
        "n": pa.array(np.zeros(len(groups), dtype=np.int64) if n is None else n.astype(np.int64)),
        "total": _lists(total, "bigint"),
    })


def merge_tasks(centers: int, dim: int, maps: int, most: int) -> tuple[int, int]:
    """(tasks of the first level, salts): by the partial vectors that ``maps`` tasks may send.

    Few centroids from many tasks are added in two levels, so that no task reads all of them.
    """
    incoming = float(maps) * centers * dim * 8
    salts = int(max(1, min(np.ceil(incoming / _MERGE_BYTES / max(1, centers)), np.ceil(np.sqrt(maps)))))
    wanted = max(np.ceil(incoming / _MERGE_BYTES), np.ceil(centers * dim * 8 / _MERGE_BYTES))
    waves = max(most, np.ceil(centers * dim * 8 / _MERGE_BYTES))
    return int(max(1, min(wanted, centers * salts, waves))), salts


def _added(batches: Iterator[pa.RecordBatch], dim: int):
    """(counts and costs, vector sums) of equal (group, cluster, limb), added by sorting; None for what has no rows."""
    def add(parts):
        g, c, limb, held = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((limb, c, g))
        starts = kernels.run_starts(g[order], c[order], limb[order])[:-1]
        return [(g[order][starts], c[order][starts], limb[order][starts], np.add.reduceat(held[order], starts, axis=0))]

    held, rows, limit = ([], []), [0, 0], max(1, _MERGE_BYTES // (8 * dim))
    limits = [limit, limit]
    for batch in batches:
        vectors = np.diff(batch["total"].offsets.to_numpy()) > 0
        for kind, mask in enumerate((~vectors, vectors)):
            part = batch.filter(pa.array(mask))
            if not part.num_rows:
                continue
            value = kernels.matrix(part["total"], dim) if kind else part["n"].to_numpy()
            held[kind].append((part[G].to_numpy(), part["cluster"].to_numpy(), part["limb"].to_numpy(), value))
            rows[kind] += part.num_rows
            if rows[kind] > limits[kind]:
                held[kind][:] = add(held[kind])
                rows[kind] = len(held[kind][0][0])
                limits[kind] = max(limits[kind], 2 * rows[kind])
    return tuple(add(x)[0] if x else None for x in held)


def _means(scalars, vectors, dim: int, space: Space) -> Iterator[pa.RecordBatch]:
    """The mean of every cluster and the cost of every group from merged partial sums."""
    g, c, limb, n = scalars
    rows = c != _COST
    ids, counts = np.stack([g[rows], c[rows]]), n[rows]  # in order, one row each
    sums = {}
    if vectors is not None:
        vg, vc, vl, total = vectors
        keys = np.rec.fromarrays([ids[0], ids[1]])
        at = np.searchsorted(keys, np.rec.fromarrays([vg.astype(np.int64), vc.astype(np.int64)], dtype=keys.dtype))
        for one in np.unique(vl):
            sums[int(one)] = np.zeros((len(counts), dim), dtype=np.int64)
            sums[int(one)][at[vl == one]] = total[vl == one]
    if len(counts):
        yield _mean_batch(ids[0], ids[1], counts, np.zeros(len(counts)), space.mean(sums, counts, dim), space)
    groups, slot = np.unique(g[~rows], return_inverse=True)
    if len(groups):
        parts = {}
        for one in np.unique(limb[~rows]):
            parts[int(one)] = np.zeros((len(groups), 1), dtype=np.int64)
            mine = limb[~rows] == one
            parts[int(one)][slot[mine], 0] = n[~rows][mine]
        cost = limbs.quotient(parts, np.ones(len(groups), dtype=np.int64))[:, 0]
        none = np.zeros((len(groups), 0))
        yield _mean_batch(groups, np.full(len(groups), _COST), np.zeros(len(groups)), cost, none, space)


def _mean_batch(groups, clusters, n, cost, mean, space: Space) -> pa.RecordBatch:
    return pa.record_batch({
        G: pa.array(groups.astype(np.int64)),
        "cluster": pa.array(clusters.astype(np.int32)),
        "n": pa.array(n.astype(np.int64)),
        "cost": pa.array(cost),
        "mean": _lists(mean, space.element),
    })


def _merge(partials: DataFrame, centers: int, dim: int, maps: int, space: Space) -> DataFrame:
    """Add the partial sums of every cluster and take the mean; also the cost of every group.

    Hash partitioning brings all partial sums of a cluster to one task, or with many of them to
    one task for each salt first. A task holds about one vector per cluster and limb of its partition.
    """
    tasks, salts = merge_tasks(centers, dim, maps, 4 * parallelism(partials.sparkSession))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scalars, vectors = _added(batches, dim)
        if scalars is not None:
            yield _scalars(*scalars)
        if vectors is not None:
            yield _vectors(*vectors)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scalars, vectors = _added(batches, dim)
        if scalars is not None:
            yield from _means(scalars, vectors, dim, space)

    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        salted = partials.withColumn("salt", salt).repartition(tasks, G, "cluster", "salt")
        partials = salted.drop("salt").mapInArrow(combine, _PARTIAL)
    return partials.repartition(tasks, G, "cluster").mapInArrow(finish, _mean_ddl(space))


def _model_frame(spark: SparkSession, best: dict[int, tuple], space: Space) -> DataFrame:
    parts = [
        pa.table({
            G: pa.array(np.full(len(centers), g, dtype=np.int64)),
            "cluster": pa.array(np.arange(len(centers), dtype=np.int32)),
            "grid": _lists(centers, space.element),
            "n": pa.array(sizes),
            "objective": pa.array(np.full(len(centers), cost)),
        })
        for g, (centers, sizes, cost) in sorted(best.items())
    ]
    return spark.createDataFrame(pa.concat_tables(parts), schema=T.StructType.fromDDL(model_ddl(space)))


# --- the streamed way -------------------------------------------------------------------------


def _slices(n, k, dim: int, options: KMeansOptions, most: int, payload=None):
    """Slices of a group of n rows that meets k centroids: as many as memory needs, and up to
    ``most`` of them to share the work, while the copies of the centroids are no more than the rows."""
    held = n * F.lit(float(8 * dim))
    held = held if payload is None else held + payload
    memory = F.ceil(held / F.lit(float(options.slice_bytes)))
    work = F.least(F.ceil(n.cast("double") * k * F.lit(2 * dim / _CELL_FLOPS)), F.lit(most))
    work = F.least(work, F.ceil(n.cast("double") / k))
    return F.greatest(memory, work, F.lit(1)).cast("int").alias("slices")


def _parts(n, k, dim: int, most: int, slices):
    """Parts of a group, each of whole slices: up to ``most`` to share the work, while the copies of the centroids are no
    more than the rows, or ``_LEAST_PARTS`` where there are nearly as many centroids as rows."""
    work = F.least(F.ceil(n.cast("double") * k * F.lit(2 * dim / _CELL_FLOPS)), F.lit(most))
    work = F.least(work, F.greatest(F.ceil(n.cast("double") / k), F.lit(_LEAST_PARTS)))
    return F.greatest(F.least(work, slices), F.lit(1)).cast("int").alias("parts")


def _sliced(rows: DataFrame, slices: DataFrame, tasks: int, space: Space) -> DataFrame:
    """Rows (_g, part, slice, id, packed, payload) hash-partitioned by group and part.

    A slice is a fixed hash of the row id, so a group of any size is spread over many tasks.
    """
    slice_ = F.pmod(F.xxhash64(ID), F.col("slices")).cast("int")
    cut = attach(rows, slices, "slices", "parts").withColumn("slice", slice_).select(
        G, F.pmod("slice", "parts").alias("part"), F.lit(1).alias("kind"), "slice", F.col(ID).alias("at"), "packed",
        F.lit(None).cast(f"array<{space.element}>").alias("grid"), "payload",
    )
    return cut.repartition(tasks, G, "part")


def _meet(sliced: DataFrame, centers: DataFrame, slices: DataFrame, tasks: int) -> DataFrame:
    """The centroids of a group (kind 0) and then the rows of a part of it (kind 1), slice by slice.

    Both sides have one partitioning, which the union keeps: rows cached in it stay where they
    are and only centroids move. The last repartition is dropped from the plan then.
    """
    payload = sliced.schema["payload"].dataType
    copies = attach(centers, slices, "parts").select(
        G,
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("kind"),
        F.lit(-1).alias("slice"),
        F.col("cluster").cast("bigint").alias("at"),
        F.lit(None).cast("binary").alias("packed"),
        "grid",
        F.lit(None).cast(payload).alias("payload"),
    )
    return (
        sliced.unionByName(copies.repartition(tasks, G, "part"))
        .repartition(tasks, G, "part")
        .sortWithinPartitions(G, "part", "kind", "slice", "at")
    )


def _cell_tasks(slices: DataFrame) -> int:
    """Two tasks per part, which evens out what hashing puts together."""
    cells = slices.agg(F.sum("parts")).first()[0] or 0
    return int(min(max(1, 2 * cells), _CELL_TASKS))


class _Spool:
    """Centroids of one group in order: a few in memory, more in a temporary file that is gone with the task."""

    def __init__(self, dim: int, space: Space):
        self.dim, self.clusters = dim, []
        self.kind = np.dtype(np.int32 if space.element == "int" else np.float64)
        self.file = tempfile.SpooledTemporaryFile(max_size=_SPOOL_BYTES)

    def add(self, batch: pa.RecordBatch) -> None:
        self.clusters.append(batch["at"].to_numpy().astype(np.int32))
        self.file.write(np.ascontiguousarray(kernels.matrix(batch["grid"], self.dim), self.kind).data)

    def read(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(clusters, centres) of ``_SPOOL_BYTES`` at most, or one."""
        if len(self.clusters) > 1:
            self.clusters = [np.concatenate(self.clusters)]
        self.file.seek(0)
        count = sum(map(len, self.clusters))
        step = max(1, _SPOOL_BYTES // (8 * self.dim))
        for a in range(0, count, step):
            clusters = self.clusters[0][a : a + step]
            data = self.file.read(len(clusters) * self.dim * self.kind.itemsize)
            yield clusters, np.frombuffer(data, self.kind).reshape(-1, self.dim).astype(np.float64)

    def close(self) -> None:
        self.file.close()


class _Cell:
    """Rows of one slice and their nearest centroid among those seen so far."""

    def __init__(self, dim: int, space: Space):
        self.dim, self.space, self.batches, self.x = dim, space, [], None

    def add_rows(self, batch: pa.RecordBatch) -> None:
        self.batches.append(batch)

    def meet(self, spool: _Spool) -> None:
        for clusters, centers in spool.read():
            self.see(clusters, centers)

    def see(self, clusters: np.ndarray, centers: np.ndarray) -> None:
        if self.x is None:
            self.rows = pa.Table.from_batches(self.batches)
            self.x = packed.unpack(self.rows["packed"], self.dim, self.space)
            self.cluster = np.zeros(len(self.x), dtype=np.int64)
            self.dist = np.full(len(self.x), np.inf)
        at, found = self.space.nearest(self.x, self.space.prepare(centers))
        better = found < self.dist
        self.dist[better] = found[better]
        self.cluster[better] = clusters[at[better]]


def _cells(batches: Iterator[pa.RecordBatch], dim: int, space: Space) -> Iterator[tuple[int, _Cell]]:
    """Walk a partition made by :func:`_meet`; yields (group, cell) for every slice, once it has met the centroids."""
    key, place, cell, spool = None, None, None, None
    try:
        for batch in batches:
            g, part, kind, slice_ = (batch[c].to_numpy() for c in (G, "part", "kind", "slice"))
            starts = kernels.run_starts(g, part, kind, slice_)
            for a, b in zip(starts, starts[1:]):
                if cell is not None and (key, place) != ((g[a], part[a]), slice_[a]):
                    cell.meet(spool)
                    yield int(key[0]), cell
                    cell = None
                if key != (g[a], part[a]):
                    if spool is not None:
                        spool.close()
                    key, spool = (g[a], part[a]), _Spool(dim, space)
                if kind[a] == 0:
                    spool.add(batch.slice(a, b - a))
                    continue
                if cell is None:
                    place, cell = slice_[a], _Cell(dim, space)
                cell.add_rows(batch.slice(a, b - a))
        if cell is not None:
            cell.meet(spool)
            yield int(key[0]), cell
    finally:
        if spool is not None:
            spool.close()


def _complete(group: int, cell: _Cell) -> _Cell:
    if cell.x is None:
        raise ValueError(f"group {group} has no centroids")
    return cell


def _fit_streamed(rows, plan: Plan, dim, space: Space, options) -> DataFrame:
    most = 4 * parallelism(rows.sparkSession)
    slices = plan.frame.select(G, "m", "k", _slices(F.col("m"), F.col("k"), dim, options, most))
    slices = slices.select(G, "slices", _parts(F.col("m"), F.col("k"), dim, most, F.col("slices")))
    tasks = _cell_tasks(slices)
    runs = []
    for restart in range(options.n_init):
        starts = checkpoint(_start_rows(rows, plan, restart, space))
        _check_starts(starts.count(), plan)
        last = starts.groupBy(G).agg(F.max("h").alias("last"))
        sample = _sample(rows, plan, last, restart).select(
            G, ID, "vec", F.lit(None).cast("int").alias("payload"),
        )
        sample = packed.packed_rows(sample, "vec", dim, space)
        sample = _sliced(sample, slices, tasks, space).persist(StorageLevel.MEMORY_AND_DISK)
        model, held = starts.select(G, "cluster", "grid"), []
        for turn in range(options.max_iter):
            met = _meet(sample, model, slices, tasks)
            split = turn + 1 < options.max_iter or space.split_last
            made, moved = _streamed_pass(met, model, plan, dim, tasks, space, split)
            for old in held:  # the pass that read them is done
                old.drop()
            held, state, cost = made, made[-1].frame, made[0].frame
            model = state.select(G, "cluster", "grid")
            if not moved:
                break
        sample.unpersist()
        cost = cost.filter(F.col("cluster") == _COST).select(G, F.col("cost").alias("objective"))
        runs.append(
            state.join(cost, G).select(
                G, "cluster", "grid", "n", "objective", F.lit(restart).alias("restart")
            )
        )
    if len(runs) == 1:
        return runs[0].drop("restart")
    every = reduce(DataFrame.unionByName, runs)
    chosen = every.groupBy(G).agg(
        F.min(F.struct("objective", "restart")).getField("restart").alias("restart")
    )
    return every.join(chosen, [G, "restart"]).drop("restart")


def _streamed_pass(met: DataFrame, model: DataFrame, plan: Plan, dim: int, tasks: int, space: Space, split: bool):
    """([merged sums, ..., state], whether a centroid moved): tables of this pass, the first and last are needed on."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, cell in _cells(batches, dim, space):
            cell = _complete(group, cell)
            ids, at = np.unique(cell.cluster, return_inverse=True)
            found = _Partial(space)
            found.add(cell.x, at, cell.dist, np.zeros(len(at), dtype=np.int64), len(ids), 1)
            yield from found.batches(np.full(len(ids), group), ids, np.array([group]))

    merged = store(_merge(met.mapInArrow(partial, _PARTIAL), plan.centers, dim, tasks, space), "pass-sums")
    means = merged.frame.filter(F.col("cluster") != _COST).select(G, "cluster", "n", "mean")
    state = model.join(means, [G, "cluster"], "left").select(
        G,
        "cluster",
        F.col("grid").alias("old"),
        F.coalesce("mean", "grid").alias("grid"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    made = [merged, store(state, "pass-model")]
    changed = F.col("grid") != F.col("old")
    empty, moved = made[-1].frame.agg(F.count_if(F.col("n") == 0), F.count_if(changed)).first()
    if empty and split:
        made.append(store(_refilled(made[-1].frame, plan, space), "pass-model"))
        moved = made[-1].frame.filter(changed).count()
    return made, moved > 0


def _refilled(state: DataFrame, plan: Plan, space: Space) -> DataFrame:
    """The relational form of ``kernels.refill``: ids and counts are ranked, then vectors joined."""
    span = F.floor(F.col("cluster") / F.lit(_RANK_ROWS))
    slim = state.select(G, "cluster", "n", span.alias("span"))
    empty, donors = slim.filter("n = 0"), slim.filter("n >= 2")
    if plan.max_k <= _RANK_ROWS:
        empty = _ranked(empty, ["cluster"])
        donors = _ranked(donors, [F.desc("n"), "cluster"])
    else:
        empty = _ranked(empty, ["cluster"], ["span"], ["span"])
        donors = donors.withColumn("size", F.col("n"))
        donors = _ranked(donors, ["cluster"], ["size", "span"], [F.desc("size"), "span"])
    pairs = empty.select(G, "rank", F.col("cluster").alias("taker")).join(
        donors.select(G, "rank", "cluster"), [G, "rank"]
    )
    halves = state.select(G, "cluster", "grid").join(pairs, [G, "cluster"]).withColumn("step", space.steps_column("grid"))
    moved = halves.select(
        G,
        F.inline(F.array(
            F.struct(F.col("taker").alias("cluster"),
                     F.zip_with("grid", "step", lambda c, s: c + s).alias("moved")),
            F.struct(F.col("cluster"),
                     F.zip_with("grid", "step", lambda c, s: c - s).alias("moved")),
        )),
    )
    return state.join(moved, [G, "cluster"], "left").select(
        G, "cluster", "old", F.coalesce("moved", "grid").alias("grid"), "n"
    )


# --- assignment -------------------------------------------------------------------------------


def assign_groups(
    df, model, vec, group, row_id, dim, space: Space, options, out: T.StructType, mark: str | None = None
) -> DataFrame:
    """Columns of ``df`` plus nearest centroid of the row's group and squared distance.

    ``mark`` names a flag that is true for the rows nearest to their centroid within the batch or
    slice at hand: the only ones that can be nearest in the whole table.
    """
    most = options.broadcast_bytes if df.isStreaming else min(options.broadcast_bytes, _DRIVER_MODEL_BYTES)
    budget = most // (8 * dim)
    head = model.select(G, "cluster", "grid").limit(budget + 1).toArrow()
    names, unit = df.columns, space.unit
    if mark:
        require_columns(df, row_id)
        out = T.StructType([*out.fields, T.StructField(mark, T.BooleanType())])

    def results(clusters, place, dist, ids) -> list[pa.Array]:
        columns = [pa.array(clusters.astype(np.int32)), pa.array(dist / unit)]
        if mark:
            columns.append(pa.array(kernels.first_rows(place, dist, ids.to_numpy())))
        return columns

    def assign_broadcast(df: DataFrame, head: pa.Table) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(Model.of(head, dim, space))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = sent.value
            for batch in batches:
                x = space.load(kernels.matrix(batch[vec], dim))
                at, dist = m.nearest(batch[G].to_numpy(), x)
                found = results(m.clusters[at], at, dist, batch[row_id] if mark else None)
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *found], out.names)

        return df.withColumn(G, group.cast("bigint")).mapInArrow(near, out)

    if head.num_rows <= budget:
        return assign_broadcast(df, head)
    del head
    if df.isStreaming:
        raise ValueError("the centroids exceed the broadcast budget of a streaming assignment")
    require_columns(df, row_id)
    groups = model.groupBy(G).agg(F.count(F.lit(1)).alias("k")).limit(_LOCAL_PLAN_ROWS + 1).toArrow()
    dealt = _dealt(groups, budget) if groups.num_rows <= _LOCAL_PLAN_ROWS else np.full(groups.num_rows, _ROUNDS)
    parts, rounds = [], np.unique(dealt)
    for r in rounds[rounds < _ROUNDS]:
        # the first round also takes the rows of groups without centroids, which must fail and not vanish
        others = _named(df.sparkSession, groups, dealt != r if r == rounds[0] else dealt == r)
        how = "left_anti" if r == rounds[0] else "left_semi"
        wanted = _named(df.sparkSession, groups, dealt == r)
        centers = model.select(G, "cluster", "grid").join(wanted, F.col(G) == F.col("_named"), "left_semi")
        mine = df.join(others, group.cast("bigint") == F.col("_named"), how)
        parts.append(assign_broadcast(mine, centers.toArrow()))
    if parts:
        if rounds[-1] < _ROUNDS:
            return reduce(DataFrame.unionByName, parts)
        wanted = _named(df.sparkSession, groups, dealt == _ROUNDS)
        df = df.join(wanted, group.cast("bigint") == F.col("_named"), "left_semi")
        model = model.join(wanted, F.col(G) == F.col("_named"), "left_semi")
    rows = df.select(
        group.cast("bigint").alias(G),
        F.col(row_id).cast("bigint").alias(ID),
        F.col(vec).alias("vec"),
        F.struct(*names).alias("payload"),
    )
    rows = packed.packed_rows(rows, "vec", dim, space)
    sizes = df.groupBy(group.cast("bigint").alias(G)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(payload_bytes(df, set())).alias("bytes")
    )
    sizes = settle(sizes, _LOCAL_PLAN_ROWS)
    centers = settle(model.groupBy(G).agg(F.count(F.lit(1)).alias("k")), _LOCAL_PLAN_ROWS)
    most = 4 * parallelism(df.sparkSession)
    slices = _slices(F.col("n"), F.col("k"), dim, options, most, F.col("bytes"))
    # A left join: rows of a group without centroids must fail later, not vanish.
    slices = sizes.join(centers, G, "left").select(G, "n", "k", F.coalesce(slices, F.lit(1)).alias("slices"))
    shared = F.coalesce(_parts(F.col("n"), F.col("k"), dim, most, F.col("slices")), F.lit(1))
    slices = slices.select(G, "slices", shared.alias("parts"))
    slices = settle(slices, _LOCAL_PLAN_ROWS)
    tasks = _cell_tasks(slices)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, cell in _cells(batches, dim, space):
            cell = _complete(g, cell)
            found = results(cell.cluster, cell.cluster, cell.dist, cell.rows["at"])
            yield from pa.Table.from_arrays(
                [cell.rows["payload"], *found], ["payload", *out.names[len(names):]]
            ).to_batches(_OUT_ROWS)

    schema = T.StructType(
        [T.StructField("payload", rows.schema["payload"].dataType), *out.fields[len(names):]]
    )
    met = _meet(_sliced(rows, slices, tasks, space), model, slices, tasks)
    parts.append(met.mapInArrow(meet, schema).select("payload.*", *out.names[len(names):]))
    return reduce(DataFrame.unionByName, parts)


def _named(spark: SparkSession, groups: pa.Table, which: np.ndarray) -> DataFrame:
    named = groups.select([G]).filter(pa.array(which)).rename_columns(["_named"])
    return spark.createDataFrame(named, "_named bigint")


def cluster_local_groups(
    rows: DataFrame, vec: str, dim: int, space: Space, max_iter: int, groups: int, names: list[str],
    out: T.StructType,
) -> DataFrame:
    """Train and assign inside one task per group.

    ``rows`` has the columns ``names`` plus (_g, _id, _h, k, cut). The output adds cluster,
    squared distance, and whether the row is the nearest one of its cluster.
    """
    def run(table: pa.Table) -> pa.Table:
        x, k, hashes, ids, cut = _group_inputs(table, vec, dim, space)
        centers, _, _ = training.train(space, x, k, hashes, ids, cut, max_iter)
        index, dist = space.nearest(x, space.prepare(centers))
        columns = [table[name] for name in names]
        columns.append(pa.chunked_array([index.astype(np.int32)]))
        columns.append(pa.chunked_array([dist / space.unit]))
        columns.append(pa.chunked_array([pa.array(kernels.first_rows(index, dist, ids))]))
        return pa.Table.from_arrays(columns, names=out.names)

    tasks = _tasks(rows.sparkSession, groups)
    return rows.repartition(tasks, G).groupBy(G).applyInArrow(run, out)
