"""Near-duplicate vectors against all pairs, and the graph's parts."""

import numpy as np
import pandas as pd
import pytest

from nestmeans.llm import vector_graph as G
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def brute(rows):
    """{id: (links, component)} of (id, vector, label) rows."""
    ok = [
        (i, np.array(v, float), lab) for i, v, lab in rows
        if i is not None and v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i, *_ in rows if i is not None}
    for lab in {x[2] for x in ok}:
        own = [x for x in ok if x[2] == lab]
        for k, (i, v, _) in enumerate(own):
            for j, w, _ in own[k + 1:]:
                if i != j and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                    links[i].add(j)
                    links[j].add(i)
    root = {i: i for i in links}
    for _ in root:
        changed = False
        for i, js in links.items():
            low = min([root[i], *(root[j] for j in js)])
            for j in [i, *js]:
                changed |= root[j] != low
                root[j] = low
        if not changed:
            break
    return {i: (len(js), root[i]) for i, js in links.items()}


def answer(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    df = QUERIES["op4_vector_graph"](spark, DATA)
    assert answer(df) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in df.collect())


def clouds(n, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    hearts = rng.normal(size=(max(1, n // 12), 16))
    hearts /= np.linalg.norm(hearts, axis=1, keepdims=True)
    own = hearts[rng.integers(0, len(hearts), n)] + spread * rng.normal(size=(n, 16))
    return own * rng.uniform(0.5, 2, (n, 1))


def test_shards_and_recall(spark):
    x = clouds(900, 5)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    want, got = brute(rows), answer(G.near_duplicates(df, shard=60))
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][0] for i in want) >= 0.95 * sum(n for n, _ in want.values())
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= 0.9


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
        (13, [-0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [1e200, 0.0], 1), (16, [0.1, 1.0], 1), (17, [1e-300, 1e-310], 1),
    ]
    rows = [(*r, "a") for r in rows] + [(1, [1.0, 0.0], 1, "b"), (None, [1.0, 0.0], 1, "c")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, node string")
    got = G.near_duplicates(df).collect()
    assert len(got) == len(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert found[None] == (0, None)
    assert found == {
        **{i: (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)}, **{i: (4, 1) for i in (1, 2, 3, 15, 17)},
        13: (2, 13), 14: (2, 13), 16: (2, 13), None: (0, None),
    }
    assert G.near_duplicates(df.limit(0)).count() == 0


def test_graph_reaches_all_in_range():
    x = G.unit(clouds(600, 3)).astype(np.float32)
    graph, medoids = G.build(x)
    assert graph.shape == (600, G.DEGREE) and not (graph == np.arange(600)[:, None]).any()
    reached = G.in_range(x, graph, np.arange(600), medoids, G.BEAM, 0.9)
    reached |= reached.T  # links count from either side
    truth = x @ x.T >= 0.98
    assert (reached & truth).sum() >= 0.99 * truth.sum()
    nodes, _ = G.greedy(x, graph, x[:100], np.tile(medoids, (100, 1)), 32)
    assert np.mean([i in row for i, row in enumerate(nodes)]) >= 0.95


def test_robust_prune():
    x = G.unit(np.array([[1, 0], [1, 0.1], [1, 0.11], [0, 1], [1, -0.5]])).astype(np.float32)
    kept = G.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 0, 1, -1]]), 4)
    assert kept[0].tolist() == [1, 4, 3, -1]


def test_audit(spark):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(clouds(120, 9))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    _, nodes = G._nodes(df, "vec_id", "embedding", "label")
    want = brute(rows)
    assert {r["node"]: r["truth"] for r in G.audit(nodes, 0.98).collect()} == {i: n for i, (n, _) in want.items()}


def test_one_direction_larger_than_a_shard(spark):
    v = np.random.default_rng(4).normal(size=8)
    rows = [(i, (v * (i + 1)).tolist(), 1) for i in range(150)]  # scaled copies: one node
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    members, nodes = G._nodes(df, "vec_id", "embedding", "label")
    assert members.count() == 150 and [r["copies"] for r in nodes.collect()] == [150]
    assert answer(G.near_duplicates(df, shard=20)) == {i: (149, 0) for i in range(150)}


def test_nodes_that_no_centroid_separates_stay(spark):
    vectors = [[1.0, 2.0, 2.0]] * 150 + [x.tolist() for x in clouds(60, 6)[:, :3]]
    rows = [(i, 7, 1, v) for i, v in enumerate(vectors)]
    nodes = spark.createDataFrame(rows, "node bigint, field bigint, copies bigint, vector array<double>")
    shards = G._shards(nodes, 20, 2).collect()
    assert sorted(r["node"] for r in shards if r["home"]) == list(range(210))
    assert len(shards) <= 4 * 210
    tied = {r["node"] for r in shards if r["tied"]}
    assert tied >= set(range(150))
    found, placed = G._search(nodes, 0.98, 2, 48, 20)
    todo = placed.where("home AND tied").select("node", placed["shard"].alias("block"))
    got = {r["node"]: r["links"] for r in G.finish(nodes, found, todo, 0.98).where("other IS NULL").collect()}
    u = G.unit(np.array(vectors))
    truth = (u @ u.T >= 0.98).sum(axis=1) - 1
    assert all(got[i] == truth[i] for i in tied)


def test_exact_links_and_forest():
    x = clouds(300, 8)
    ids = np.arange(300)
    frame = {"node": ids, "field": 1, "copies": 1 + ids % 3, "vector": list(x)}
    asked = pd.DataFrame({**frame, "block": ids % 4}).iloc[::2]
    got = pd.concat(G.exact_links(asked, 0.98)(iter([pd.DataFrame(frame).iloc[:170], pd.DataFrame(frame).iloc[170:]])))
    u = G.unit(x)
    truth = (u @ u.T >= 0.98) & ~np.eye(300, dtype=bool)
    counts = got[got["other"].isna()]
    own = counts[counts["asked"]].groupby("node")["links"].sum()
    assert {i: own.get(i, 0) for i in ids[::2]} == {i: int(truth[i] @ (1 + ids % 3)) for i in ids[::2]}
    met = counts[~counts["asked"]].groupby("node")["links"].sum()
    assert {i: met.get(i, 0) for i in ids} == {i: int(truth[i, ::2] @ (1 + ids[::2] % 3)) for i in ids}
    edges = got[got["other"].notna()]
    assert len(edges) <= 300 + 150

    def classes(pairs):
        root = ids.copy()
        for a, b in pairs:
            root[root == root[b]] = root[a]
        return {frozenset(ids[root == r].tolist()) for r in root}

    assert classes(zip(edges["node"], edges["other"].astype(int))) == classes((a, b) for a, b in np.argwhere(truth) if a % 2 == 0)


def test_dense_group_larger_than_a_shard(spark):
    rng = np.random.default_rng(4)
    w = rng.normal(size=8)
    rows = [(i, (w + 0.05 * rng.normal(size=8)).tolist(), 1) for i in range(200)]  # most within 0.98 of each other
    rows += [(400 + i, x.tolist(), 1) for i, x in enumerate(clouds(60, 6)[:, :8])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    got, want = answer(G.near_duplicates(df, shard=50)), brute(rows)
    assert min(want[i][0] for i in range(200)) > 2 * 50
    assert {i: got[i] for i in range(200)} == {i: want[i] for i in range(200)}


def test_audit_asks_nodes_with_links(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    x[299] = x[298] + 0.01
    nodes = spark.createDataFrame([(i, 7, 1, v.tolist()) for i, v in enumerate(x)], "node bigint, field bigint, copies bigint, vector array<double>")
    linked = nodes.where("node >= 298").select("node")
    asked = {r["node"]: r["truth"] for r in G.audit(nodes, 0.98, 2, linked).collect()}
    assert len(asked) <= 4 and asked[298] == asked[299] == 1
