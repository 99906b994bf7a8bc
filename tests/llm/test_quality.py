"""Quality votes: held-out accuracy, an independent vote, and edge rows."""

import re

import numpy as np
import pyarrow as pa
import pytest

from nestmeans.llm import quality
from nestmeans.llm import words as W
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.1"


def test_query_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = QUERIES["op10_quality"](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    good = [r["predicted"] == 1 for r in held if truth[r["doc_id"]] == 1]
    bad = [r["predicted"] == 0 for r in held if truth[r["doc_id"]] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def tables(spark):
    good = [(i, f"This is sentence {i}. It tells a little about item {i * 7}.") for i in range(40)]
    bad = [(100 + i, f"buy!! now!! {i}!! " * 6) for i in range(40)]
    docs = [*good, *bad, (200, None), (201, ""), (202, " \n"), (203, "x" * 300000), (203, "x" * 300000), (None, "This is fine.")]
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(300, 1), (1, None), (2, 7), (None, 0), (3, 1)]
    return (
        spark.createDataFrame([(*d, "s") for d in docs], "doc_id bigint, text string, score string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
    )


def test_edge_rows(spark):
    docs, labels = tables(spark)
    got = quality.grade(docs, labels).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == 1 for i in range(40)) and all(by_id[100 + i]["predicted"] == 0 for i in range(40))
    assert [by_id[i]["score"] for i in (200, 201, 202)] == [0.0] * 3
    assert by_id[None]["held_out"] and by_id[None]["predicted"] == 1
    assert {r["score"] for r in quality.grade(docs, labels.limit(0)).collect()} == {0.0}
    assert quality.grade(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= set(range(40)) and kept.where("doc_id between 100 and 202").count() == 0


def test_votes_match_plain_computation():
    rng = np.random.default_rng(1)
    model = quality.Model(
        np.ones(quality.FEATURES, np.float32), rng.standard_normal((quality.FEATURES, 8)).astype(np.float32),
        quality.unit(rng.standard_normal((60, 8)).astype(np.float32)), rng.integers(0, 2, 60), rng.choice([1.0, 2.5], 60),
    )
    counts = rng.poisson(0.05, (5, quality.FEATURES)).astype(np.float32)
    got = model.scores(counts, np.ones(5))
    for c, g in zip(counts, got):
        x = np.log1p(c)
        z = (x / np.linalg.norm(x)) @ model.axes
        near = model.vectors @ (z / np.linalg.norm(z))
        at = np.argsort(-near)[:quality.NEIGHBOURS]
        vote = np.maximum(near[at], 1e-6) * model.weights[at]
        assert g == pytest.approx((vote * model.labels[at]).sum() / vote.sum(), abs=1e-4)


def test_counts():
    texts = ["a a b", "", "Ab 1!", "é é é é"]
    counts, words = quality.counts_of(*W.text_bytes(pa.array(texts), 0, 4))
    assert words.tolist() == [3, 0, 2, 4]
    assert counts[:, :quality.WORD_BUCKETS].sum(axis=1).tolist() == [3, 0, 2, 4]
    size = [len(t) for t in texts]
    assert counts[:, quality.WORD_BUCKETS:quality.REPEATS].sum(axis=1).tolist() == [sum(max(0, n - k) for k in range(3)) for n in size]
    assert counts[3, quality.REPEATS:].nonzero()[0].tolist() == [12, 16 + 4]


def test_axes_span_the_leading_directions():
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((200, 5)) @ rng.standard_normal((5, 300))).astype(np.float32)
    axes = quality.latent_axes(x, 5)
    assert np.allclose(x @ axes @ axes.T, x, atol=1e-2)
