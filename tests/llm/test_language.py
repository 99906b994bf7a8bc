"""Language identification: held-out accuracy, calibration and edge rows."""

import math

import numpy as np
import pytest

from nestmeans.llm import language
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_query_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language"](spark, DATA).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert 0.2 < len(held) / len(rows) < 0.3
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in held]
    assert np.mean(right) >= 0.97
    # calibrated: mean score close to accuracy
    assert abs(np.mean([r["score"] for r in held]) - np.mean(right)) < 0.05
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_rows(spark):
    texts = ["the cat sat", "der Hund lief", None, "", "123 !?", "la casa", "é" * 100000, "ﬁ"]
    rows = [(i, t, ["en", "de", None, None, "en", "es", "fr", None][i], "z") for i, t in enumerate(texts)] * 3
    df = spark.createDataFrame([*rows, (None, "the dog", "en", "z")], "doc_id bigint, text string, lang string, score string")
    got = language.identify(df).collect()
    assert len(got) == 25
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de", "es", "fr") and 0 < r["score"] <= 1
    nothing = language.identify(df.select("doc_id", "text", language.F.lit(None).cast("string").alias("lang")))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}
    assert language.identify(df.limit(0)).count() == 0


def test_ngrams_match_strings():
    texts = ["Ab, c1d", None, "é é", "", "--x"]
    bucket, row, counts = language.all_ngrams(texts)
    assert counts.tolist() == [4, 0, 2, 0, 1]
    want = {0: "ab c d", 2: "é é", 4: "x"}
    for i, text in want.items():
        grams = [text[k:k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1)]
        own = bucket[row == i].tolist()
        assert len(own) == len(grams) and len(set(own)) == len(set(grams))


def test_regression_step_is_ftrl():
    model = language.Regression(2, 2)
    model.step(np.array([0]), np.array([2.0]), 1)
    # by hand: gradient of feature 0 is x * (p - y) = (1, -1); z = g, n = g * g
    w = -(1 - language.L1) / ((language.BETA + 1) / language.ALPHA + language.L2)
    assert model.weights(np.array([0]))[0] == pytest.approx([w, -w])
    assert model.weights(np.array([1])).tolist() == [[0, 0]]


def test_temperature():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in language.softmax(logits)])
    assert language.best_temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)
    assert not math.isnan(language.best_temperature(logits[:1], labels[:1]))
