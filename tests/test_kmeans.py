"""K-means: the three ways agree, properties, edge cases."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmeans.operators import clusters
from nestmeans.operators import kmeans as km
from nestmeans.operators.clusters import cluster_sizes, conservation, empty_clusters, representatives
from nestmeans.options import HierarchyOptions, KMeansOptions
from nestmeans.plans.hierarchy import hierarchical_cluster, stage2

WAYS = {
    "local": {},
    "broadcast": {"local_bytes": 0},
    "streamed": {"local_bytes": 0, "broadcast_bytes": 0, "slice_bytes": 8 * 12 * 30},
}


def options(way, **kw):
    return KMeansOptions(**{"max_iter": 3, "scale": 100, **WAYS[way], **kw})


def model_rows(model):
    return sorted((r.cluster, tuple(r.centroid), r.n, r.objective) for r in model.collect())


@pytest.mark.parametrize(
    "k, extra",
    [(5, {}), (60, {}), (1, {}), (500, {}), (6, {"n_init": 3}),
     (10, {"max_points_per_centroid": 4})],
)
def test_ways_agree(vectors, k, extra):
    results = [model_rows(km.kmeans_fit(vectors, k, options=options(w, **extra))) for w in WAYS]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == min(k, 200)


def spread_vectors(spark):
    """Clusters at 0 and 0.05, far ones, and one row a million times as long as the rest."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1e-4, 6) + [0.0, 0.05, -3.0][i % 3]).tolist()) for i in range(240)]
    rows += [(900, [1e6] * 6), (901, [1e-30] * 6)] + [(1000 + i, rows[i][1]) for i in range(20)]
    return spark.createDataFrame(rows, "row_id bigint, fp array<double>").repartition(3)


@pytest.mark.parametrize("k, extra", [(5, {}), (40, {}), (1, {}), (300, {}), (6, {"n_init": 3})])
def test_ways_agree_without_a_grid(spark, k, extra):
    rows = spread_vectors(spark)
    results = [model_rows(km.kmeans_fit(rows, k, options=options(w, scale=None, **extra))) for w in WAYS]
    assert results[0] == results[1] == results[2]
    again = model_rows(km.kmeans_fit(rows.repartition(7), k, options=options("broadcast", scale=None, **extra)))
    assert again == results[0] and sum(r[2] for r in again) == 262


def test_bounds_change_nothing(spark, vectors, monkeypatch):
    """Passes with and without bounds, in a task and over the cluster, on and off the grid."""
    for scale in (100, None):
        found = []
        for least in (1, 10_000):
            monkeypatch.setattr(km.bounds, "LEAST_CENTERS", least)
            monkeypatch.setattr(km.bounds, "LEAST_ROWS", 1)
            found += [model_rows(km.kmeans_fit(vectors, 30, options=options("local", scale=scale, max_iter=6)))]
        monkeypatch.setattr(km.bounds, "LEAST_CENTERS", 1)
        found += [model_rows(km.kmeans_fit(vectors, 30, options=options("broadcast", scale=scale, max_iter=6)))]
        assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("way", list(WAYS))
def test_an_outlier_takes_no_resolution_from_the_others(spark, way):
    rows = [(i, [0.0] * 64) for i in range(300)] + [(300 + i, [0.05] * 64) for i in range(300)] + [(600, [1e6] * 64)]
    df = spark.createDataFrame(rows, "row_id bigint, fp array<float>")
    o = KMeansOptions(**WAYS[way])
    model = km.kmeans_fit(df, 3, options=o)
    found = {r.centroid[0]: r.n for r in model.collect()}
    assert found == {0.0: 300, float(np.float32(0.05)): 300, 1e6: 1}
    assert model.first().objective == 0
    sizes = km.kmeans_assign(df, model, options=o).groupBy("cluster").agg(F.count("*").alias("n"), F.max("dist").alias("d")).collect()
    assert sorted((r.n, r.d) for r in sizes) == [(1, 0.0), (300, 0.0), (300, 0.0)]


def test_returned_centroids_are_means(spark):
    """Also those of a run that ends before it settles, with more clusters than places."""
    df = spread_vectors(spark)
    for way, passes in [("local", 1), ("broadcast", 2), ("streamed", 2)]:
        o = options(way, scale=None, max_iter=passes)
        before = km.kmeans_fit(df, 9, options=options(way, scale=None, max_iter=passes - 1)) if passes > 1 else None
        model = {r.cluster: r for r in km.kmeans_fit(df, 9, options=o).collect()}
        assert sum(r.n for r in model.values()) == 262
        if before is not None and before.filter("n = 0").count() == 0:
            found = km.kmeans_assign(df, before, options=o).collect()
            for c, r in model.items():
                mine = [x.fp for x in found if x.cluster == c]
                assert r.n == len(mine)
                assert r.centroid == [float(sum(map(Fraction, v)) / len(mine)) for v in zip(*mine)]


def test_stage2_without_a_grid(spark):
    def run(**kw):
        rows = spread_vectors(spark).withColumn("cluster_k1", (F.col("row_id") % 7 % 3).cast("int"))
        details, centers = stage2(rows, value=5.0, options=KMeansOptions(max_iter=3, n_init=2, **kw))
        pick = ("row_id", "cluster_k1", "CLUSTER_k2", "DISTANCE_k2")
        return [sorted(map(tuple, d.select(*pick).collect())) for d in (details, centers)]

    want = run()
    assert run(local_bytes=0) == want
    assert run(local_bytes=0, broadcast_bytes=0, slice_bytes=8 * 6 * 20) == want


def test_partitioning_does_not_matter(vectors):
    a = model_rows(km.kmeans_fit(vectors, 7, options=options("broadcast")))
    b = model_rows(km.kmeans_fit(vectors.repartition(11), 7, options=options("broadcast")))
    assert a == b


def test_copies_force_refills(spark):
    """More clusters than distinct vectors: empty clusters occur in every pass."""
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "row_id bigint, fp array<double>")
    results = [model_rows(km.kmeans_fit(df, 8, options=options(w))) for w in WAYS]
    assert results[0] == results[1] == results[2]


def test_large_k_ranking_by_ranges(vectors, monkeypatch):
    want = model_rows(km.kmeans_fit(vectors, 60, options=options("local")))
    monkeypatch.setattr(km, "_RANK_ROWS", 9)
    assert model_rows(km.kmeans_fit(vectors, 60, options=options("streamed"))) == want


def brute_assign(rows, centers):
    x = np.array([r.fp for r in rows])
    d = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    return {r.row_id: (int(i), v) for r, i, v in zip(rows, d.argmin(1), d.min(1))}


@pytest.mark.parametrize("way", ["local", "streamed"])
def test_assign_is_brute_force(vectors, way):
    o = options(way)
    model = km.kmeans_fit(vectors, 6, options=o)
    centers = np.array([r.centroid for r in model.orderBy("cluster").collect()])
    want = brute_assign(vectors.collect(), centers)
    got = km.kmeans_assign(vectors, model, options=o).collect()
    assert len(got) == 200
    for r in got:
        assert r.cluster == want[r.row_id][0]
        assert r.dist == pytest.approx(want[r.row_id][1], abs=1e-9)


def test_equal_distance_takes_the_lowest_cluster(spark):
    df = spark.createDataFrame([(1, [1.0])], "row_id bigint, fp array<double>")
    model = spark.createDataFrame([(0, [2.0]), (1, [0.0])], "cluster int, centroid array<double>")
    assert km.kmeans_assign(df, model).first().cluster == 0


def test_objective_falls(vectors):
    costs = [
        km.kmeans_fit(vectors, 5, options=options("local", max_iter=i)).first().objective
        for i in (1, 4, 25)
    ]
    assert costs == sorted(costs, reverse=True)


def test_restarts_take_the_best(vectors):
    one = [
        km.kmeans_fit(vectors, 5, options=options("local", seed=s)).first().objective
        for s in (42, 43, 44)
    ]
    assert km.kmeans_fit(vectors, 5, options=options("local", n_init=3)).first().objective == min(one)


def test_wrong_width_fails(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "row_id bigint, fp array<double>")
    with pytest.raises(Exception, match="every vector needs"):
        km.kmeans_fit(df, 1)


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id bigint, fp array<tinyint>")
    assert km.kmeans_fit(df, 3).count() == 0
    result = hierarchical_cluster(df, HierarchyOptions(3))
    assert result.details.count() == result.centers.count() == result.report.count() == 0


def test_binary_fingerprints_stay_binary(spark, vectors):
    bits = vectors.withColumn(
        "fp", F.transform("fp", lambda x: (x.cast("int") % 2 != 0).cast("tinyint"))
    )
    result = hierarchical_cluster(bits, HierarchyOptions(3, value=4.0))
    assert result.representatives.filter("exists(fp, b -> b not in (0, 1))").count() == 0
    assert result.representatives.columns == ["row_id", "fp"]


@pytest.mark.parametrize("way", list(WAYS))
def test_hierarchy_properties(vectors, way):
    o = HierarchyOptions(4, value=6.0, stage1=options("local"), stage2=options(way))
    result = hierarchical_cluster(vectors, o)
    details, centers = result.details.collect(), result.centers.collect()
    assert sorted(r.row_id for r in details) == sorted(r.row_id for r in vectors.collect())
    best = {}
    for r in details:
        key = (r.cluster_k1, r.CLUSTER_k2)
        best[key] = min(best.get(key, (9e9, 0)), (r.DISTANCE_k2, r.row_id))
    assert {(r.cluster_k1, r.CLUSTER_k2): (r.DISTANCE_k2, r.row_id) for r in centers} == best
    report = result.report.collect()
    assert sum(r.representatives for r in report) == len(centers)
    assert all(r.representatives <= r.k2 <= r.n for r in report)
    assert sum(r.n for r in report) == 200


def test_stage2_ways_agree_and_mix(vectors):
    def run(**kw):
        o = KMeansOptions(max_iter=3, scale=100, n_init=2, **kw)
        rows = vectors.withColumn("cluster_k1", (F.col("row_id") % 7 % 3).cast("int"))
        details, centers = stage2(rows, value=5.0, options=o)
        pick = ("row_id", "cluster_k1", "CLUSTER_k2", "DISTANCE_k2")
        return [sorted(map(tuple, d.select(*pick).collect())) for d in (details, centers)]

    want = run()
    assert run(local_bytes=0) == want
    assert run(local_bytes=0, broadcast_bytes=0, slice_bytes=8 * 12 * 20) == want
    assert run(local_bytes=60 * 12 * 8) == want


def test_heavy_payload_leaves_the_local_way(spark, vectors):
    """Long texts beside the vectors count as memory of a group, and come through unchanged."""
    rows = vectors.withColumn("cluster_k1", (F.col("row_id") % 3).cast("int"))
    rows = rows.withColumn("text", F.repeat(F.col("row_id").cast("string"), 3000))
    want = stage2(rows, value=5.0, options=KMeansOptions(max_iter=2))
    small = {"local_bytes": 200_000, "slice_bytes": 100_000, "broadcast_bytes": 0}
    got = stage2(rows, value=5.0, options=KMeansOptions(max_iter=2, **small))
    for a, b in zip(want, got):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_stage2_rejects_null_groups(vectors):
    with pytest.raises(ValueError, match="NULL"):
        stage2(vectors.withColumn("cluster_k1", F.lit(None).cast("int")))


def test_representatives_skip_nan_and_break_ties(spark):
    rows = [(1, 0, float("nan")), (2, 0, 3.0), (3, 0, 3.0), (4, 1, float("nan")), (5, 2, 0.0)]
    df = spark.createDataFrame(rows, "row_id bigint, cluster int, dist double")
    got = {(r.cluster, r.row_id) for r in representatives(df, ["cluster"], "dist", ["row_id"]).collect()}
    assert got == {(0, 2), (2, 5)}


def test_representatives_sort_candidates_only(spark, monkeypatch):
    """Many types beside the keys, NULL keys, groups that return after a task has passed them on."""
    monkeypatch.setattr(clusters, "_HELD", 40)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(60)) if i % 9 else None, f"k{i % 3}", float(rng.integers(4)), [float(i)], {"a": i}) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id bigint, cluster int, part string, dist double, fp array<double>, other map<string,int>").repartition(4)
    best = {}
    for r in rows:
        key = (r[1], r[2])
        best[key] = min(best.get(key, (9e9, 0)), (r[3], r[0]))
    found = representatives(df, ["cluster", "part"], "dist", ["row_id"])
    assert {(r.cluster, r.part): (r.dist, r.row_id) for r in found.collect()} == best
    assert all(r.fp == [float(r.row_id)] and r.other == {"a": r.row_id} for r in found.collect())
    monkeypatch.undo()
    sent = clusters.nearest_candidates(df, ["cluster", "part"], "dist", ["row_id"])
    assert sent.count() <= 4 * len(best)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Sort [") < plan.index("MapInArrow")  # the sort stands above, on candidates


def test_cluster_facts(spark):
    df = spark.createDataFrame([(0,), (0,), (3,), (9,)], "cluster int")
    assert {(r.cluster, r.n) for r in cluster_sizes(df, "cluster").collect()} == {(0, 2), (3, 1), (9, 1)}
    assert {r.cluster for r in empty_clusters(df, "cluster", 5).collect()} == {1, 2, 4}
    r = conservation(df, df, "cluster", 5).first()
    assert (r.rows_in, r.rows_saved, r.rows_invalid, r.k_effective, r.k_non_empty, r.conserved) == (
        4, 3, 1, 4, 2, False)


def test_plans_of_very_large_groups(spark):
    """A third of 10^11 rows in one group: no overflow, and not in one task."""
    rows = [(0, 33_000_000_000, 66_000_000, 0), (1, 1000, 125, 0), (2, 5000, 10, 10**12)]
    sizes = spark.createDataFrame(rows, "_g bigint, n bigint, k bigint, bytes bigint")
    for limit in (256, None):
        local, large = km.make_plans(sizes, 256, KMeansOptions(max_points_per_centroid=limit), whole=True)
        assert [r._g for r in local.frame.collect()] == [1]
        assert {r._g for r in large.frame.collect()} == {0, 2}
        assert large.centers == 66_000_010 and large.max_k == 66_000_000
        first = large.frame.filter("_g = 0").first()
        if limit:
            assert first.start_cut < first.cut < first.sample_cut < 1 << 60
        else:
            assert first.start_cut < first.cut == first.sample_cut == 1 << 60


def test_plans_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(km, "_LOCAL_PLAN_ROWS", 3)
    sizes = spark.range(9).selectExpr("id as _g", "id + 1 as n", "1L as k", "0L as bytes")
    local, large = km.make_plans(sizes, 4, KMeansOptions(local_bytes=5 * 32 * 4), whole=True)
    assert (local.groups, large.groups, large.rows) == (5, 4, 30.0)


def test_trains_on_all_rows_on_a_grid_that_fits(spark):
    """Every row counts, tiny and large coordinates keep their clusters."""
    rows = [(i, [0.0, 0.0] if i % 2 else [4e-5, 4e-5]) for i in range(600)]
    df = spark.createDataFrame(rows, "row_id bigint, fp array<double>")
    model = km.kmeans_fit(df, 2)
    assert model.agg({"n": "sum"}).first()[0] == 600
    assert sorted(r.centroid[0] for r in model.collect()) == pytest.approx([0, 4e-5], rel=1e-3, abs=1e-9)
    found = km.kmeans_assign(df, model).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in found) == [300, 300]
    wide = [(i, [9_900.0 * (i % 2)] * 256) for i in range(40)]
    model = km.kmeans_fit(spark.createDataFrame(wide, "row_id bigint, fp array<double>"), 2)
    assert sorted(round(r.centroid[7]) for r in model.collect()) == [0, 9_900]


def test_merge_is_sized_by_what_comes_in():
    tasks, salts = km.merge_tasks(1000, 256, 10_000, 4 * 1000)
    assert tasks > 100 and salts >= 1
    assert km.merge_tasks(8, 64, 8, 32) == (1, 1)
    tasks, salts = km.merge_tasks(1, 4096, 100_000, 4000)
    assert tasks > 10 and salts > 10


def binary_rows(spark, n=600, dim=256, mixed=False):
    rng = np.random.default_rng(11)
    heads = rng.random((6, dim)) < 0.3
    x = (heads[rng.integers(6, size=n)] ^ (rng.random((n, dim)) < 0.03)).astype(int)
    if mixed:
        x[::7] *= -3
    rows = [(i, i % 3, x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, cluster_k1 int, fp array<tinyint>").repartition(5)


@pytest.mark.parametrize("scale", [None, 100])
@pytest.mark.parametrize("mixed", [False, True])
def test_ways_agree_on_binary_rows(spark, scale, mixed):
    rows = binary_rows(spark, mixed=mixed)
    found = [model_rows(km.kmeans_fit(rows, 9, options=options(w, scale=scale))) for w in WAYS]
    assert found[0] == found[1] == found[2]
    model = km.kmeans_fit(rows, 9, options=options("local", scale=scale))
    near = [
        {(r.row_id, r.cluster, r.dist) for r in km.kmeans_assign(rows, model, options=options(w, scale=scale)).collect()}
        for w in ("broadcast", "streamed")
    ]
    assert near[0] == near[1] and len(near[0]) == 600


@pytest.mark.parametrize("way", ["broadcast", "streamed"])
def test_binary_rows_are_cached_as_bits(spark, monkeypatch, way):
    """256 bits are held and shuffled as 32 bytes, in both ways that cache rows."""
    lengths = []
    frames = type(spark.range(1))
    persist = frames.persist

    def watch(self, *args):
        if "packed" in self.columns or self.columns == ["_g", "grid", "at", "low"]:
            column = "packed" if "packed" in self.columns else "grid"
            lengths.extend(r[0] for r in self.select(F.length(column)).distinct().collect())
        return persist(self, *args)

    monkeypatch.setattr(frames, "persist", watch)
    km.kmeans_fit(binary_rows(spark), 5, options=options(way, scale=None, max_iter=1))
    assert set(lengths) == {32}


def test_plans_of_broadcast_rounds(spark):
    """1,000 groups of 500,000 rows with 1,000 clusters each: in rounds, none streamed."""
    groups = [(g, 500_000, 1000, 0) for g in range(1000)]
    sizes = spark.createDataFrame(groups, "_g bigint, n bigint, k bigint, bytes bigint")
    o = KMeansOptions()
    _, large = km.make_plans(sizes, 256, o, whole=True)
    rounds, streamed = km.broadcast_rounds(spark, large, 256, o)
    assert streamed is None and sum(p.groups for p in rounds) == 1000 and len(rounds) == 16
    assert all(p.centers * 256 * 8 <= o.broadcast_bytes for p in rounds)
    groups = [(0, 10**10, 10**7, 0), *((g, 10**8, 40_000, 0) for g in range(1, 20))]
    sizes = spark.createDataFrame(groups, "_g bigint, n bigint, k bigint, bytes bigint")
    _, large = km.make_plans(sizes, 256, o, whole=True)
    rounds, streamed = km.broadcast_rounds(spark, large, 256, o)
    assert (len(rounds), streamed.groups, streamed.centers) == (16, 4, 10**7 + 3 * 40_000)
    every = sorted(r._g for p in [*rounds, streamed] for r in p.frame.collect())
    assert every == list(range(20))


def test_rounds_and_streams_mix(spark, monkeypatch):
    rows = binary_rows(spark, dim=12).withColumn("cluster_k1", F.when(F.col("row_id") < 330, 9).otherwise(F.col("cluster_k1")))

    def run(**kw):
        details, centers = stage2(rows, value=20.0, options=KMeansOptions(max_iter=3, **kw))
        pick = ("row_id", "cluster_k1", "CLUSTER_k2", "DISTANCE_k2")
        return [sorted(map(tuple, d.select(*pick).collect())) for d in (details, centers)]

    want, calls = run(), []
    for way in ("_fit_broadcast", "_fit_streamed"):
        fit = getattr(km, way)
        monkeypatch.setattr(km, way, lambda rows, plan, *a, fit=fit, way=way: calls.append((way, plan.groups)) or fit(rows, plan, *a))
    assert run(local_bytes=0, broadcast_bytes=8 * 12 * 5) == want
    assert calls == [("_fit_broadcast", 1)] * 3 + [("_fit_streamed", 1)]


def test_assignment_in_rounds(spark, monkeypatch):
    """A model beyond the budget whose groups fit it: no centroid is copied to slices, and rows without a group fail."""
    rows = binary_rows(spark, dim=12)
    groups = [r[0] for r in rows.select("cluster_k1").distinct().sort("cluster_k1").collect()]
    model = spark.createDataFrame(
        [(g, c, [int((c >> i) & 1) for i in range(12)]) for g in groups for c in range(4)], "_g bigint, cluster int, grid array<int>"
    )
    out = T.StructType([*rows.schema.fields, T.StructField("c", T.IntegerType()), T.StructField("d", T.DoubleType())])

    def run(model, **kw):
        space = km.space_of(1.0)
        return km.assign_groups(rows, model, "fp", F.col("cluster_k1"), "row_id", 12, space, KMeansOptions(scale=1.0, **kw), out)

    want = sorted(map(tuple, run(model).select("row_id", "c", "d").collect()))
    met, meet = [], km._meet
    monkeypatch.setattr(km, "_meet", lambda *a: met.append(a) or meet(*a))
    dealt = run(model, broadcast_bytes=8 * 12 * 4)
    assert sorted(map(tuple, dealt.select("row_id", "c", "d").collect())) == want and not met
    larger = model.unionByName(model.filter(F.col("_g") == groups[0]).withColumn("cluster", F.col("cluster") + 4))
    mixed = run(larger, broadcast_bytes=8 * 12 * 4)
    assert sorted(map(tuple, mixed.select("row_id", "c", "d").collect())) == want and met
    with pytest.raises(Exception, match="has no centroids"):
        run(model.filter(F.col("_g") != groups[0]), broadcast_bytes=8 * 12 * 4).collect()


def test_slices_copy_no_more_centroids_than_rows(spark):
    sizes = spark.createDataFrame([(250_000, 31_250)], "n bigint, k bigint")
    slices = sizes.select(km._slices(F.col("n"), F.col("k"), 512, KMeansOptions(slice_bytes=1 << 40), 400)).first()[0]
    assert slices == 8


def test_centroids_are_copied_to_parts_not_slices(spark, vectors, monkeypatch):
    """Slices of a few rows each made a copy of every centroid for each of them."""
    copies, meet = [], km._meet

    def watched(sliced, *rest):
        met = meet(sliced, *rest)
        copies.append((met.filter("kind = 0").count(), met.filter("kind = 1").select("slice").distinct().count()))
        return met

    monkeypatch.setattr(km, "_meet", watched)
    monkeypatch.setattr(km, "_SPOOL_BYTES", 8 * 12 * 7)  # several reads, from a file
    got = model_rows(km.kmeans_fit(vectors, 20, options=options("streamed", slice_bytes=8 * 12 * 4)))
    assert got == model_rows(km.kmeans_fit(vectors, 20, options=options("local")))
    assert copies and all(centers == 20 and slices > 40 for centers, slices in copies)


def test_parts_share_the_work(spark):
    rows = [(1_000_000, 125_000, 5_000), (1_000_000, 1_000_000, 5_000), (1_000_000, 125_000, 3), (100, 10, 50), (10_000_000, 1_000, 90_000)]
    sizes = spark.createDataFrame(rows, "n bigint, k bigint, s int")
    parts = sizes.select(km._parts(F.col("n"), F.col("k"), 64, 400, F.col("s")))
    assert [r[0] for r in parts.collect()] == [8, 8, 3, 1, 128]
