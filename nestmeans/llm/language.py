"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Features are the n-grams of 1 to 3 characters of the lower-cased text, with every run of other
characters than letters as one blank, hashed to ``BUCKETS`` columns; a value is the n-gram's share
of the text times its inverse document frequency over all training rows. The model is trained
with follow-the-regularised-leader (one learning rate per coordinate, L1 and L2 penalties, so
weights stay sparse) and calibrated by a temperature on rows it was not trained on.

Document frequencies come from every training row. The regression itself is fitted on a bounded
sample: at most about ``max_rows`` rows of each language, by a hash of the id, in one task.
Prediction is map-only over whole texts; the model (``BUCKETS`` x languages) goes with the tasks.

Defined cases: a NULL text or one without letters gets ``und`` and score 0; a NULL language is not
learned from; without any training row everything is ``und``; repeated rows get the same answer.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.common import held_out
from nestmeans.llm.words import mix, pieces

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_ROWS = 1500
EPOCHS = 3
CALIBRATION = 5  # one row of so many calibrates
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNDETERMINED = "und"


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(code point or 0 for a run of others, text number)`` and the letters of each text."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    known = letters()[codes]
    counts = np.bincount(rows[known], minlength=len(texts))
    keep = known.copy()
    keep[1:] |= known[:-1] & (rows[1:] == rows[:-1])
    return np.where(known, codes, 0)[keep].astype(np.uint64), rows[keep], counts


def ngrams(codes: np.ndarray, rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, text number)`` of every n-gram of one order."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.full(n, order, np.uint64)
    for i in range(order):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[i:n + i] + np.uint64(1)
    bucket = (mix(total) & np.uint64(BUCKETS - 1)).astype(np.int64)
    if order == 1:
        return bucket, rows
    whole = rows[:n] == rows[order - 1:]
    return bucket[whole], rows[:n][whole]


def all_ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket, text number)`` of all orders, by text, and the letters of each text."""
    codes, rows, counts = characters(texts)
    found = [ngrams(codes, rows, order) for order in ORDERS]
    bucket, row = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(row, kind="stable")
    return bucket[order], row[order], counts


@dataclass(frozen=True)
class Model:
    """Weights with the document frequencies folded in, and the temperature."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(texts x languages, letters of each text)``."""
        codes, rows, counts = characters(texts)
        total = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts))
        for order in ORDERS:
            bucket, row = ngrams(codes, rows, order)
            if len(row):
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                total[row[starts]] += np.add.reduceat(self.weights[bucket], starts, axis=0)
                size += np.bincount(row, minlength=len(texts))
        return softmax((total / np.maximum(size, 1)[:, None] + self.bias) / self.temperature), counts


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Regression:
    """Follow the regularised leader, proximal form, for several classes at once."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features + 1, classes))  # the last row is the bias
        self.n = np.zeros((features + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        slope = softmax(x @ w)
        slope[label] -= 1
        g = x[:, None] * slope
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, on a grid of ratios."""
    grid = np.geomspace(0.05, 20, 121)
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(BUCKETS, np.int64)
    seen = np.zeros(BUCKETS, bool)
    for batch in batches:
        for first, end in pieces(batch.column(0)):
            bucket, row, _ = all_ngrams(batch.column(0).slice(first, end - first).to_pylist())
            bounds = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(row) else [0]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                seen[:] = False
                seen[bucket[a:b]] = True
                counts += seen
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "df"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled rows as n-gram counts."""
    for batch in batches:
        for first, end in pieces(batch.column(0)):
            part = batch.slice(first, end - first)
            bucket, row, _ = all_ngrams(part.column(0).to_pylist())
            at, value = [], []
            for i in range(end - first):
                a, b = np.searchsorted(row, [i, i + 1])
                own, count = np.unique(bucket[a:b], return_counts=True)
                at.append(own.astype(np.uint32).tobytes())
                value.append(count.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                ["lang", "h", "at", "value"],
            )


def _fit(idf: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "lang"], ignore_index=True)
        names = sorted(rows["lang"].unique())
        labels = np.searchsorted(names, rows["lang"])
        found = []
        for at, value in zip(rows["at"], rows["value"], strict=True):
            at, value = np.frombuffer(at, np.uint32), np.frombuffer(value, np.uint32).astype(float)
            found.append((at, value / max(1.0, value.sum()) * idf[at]))
        scale = 1 / max(1e-9, float(np.mean([np.sqrt((x * x).sum()) for _, x in found])))
        found = [(at, x * scale) for at, x in found]
        check = np.arange(len(found)) % CALIBRATION == 0
        check = check & (len(found) >= 2 * CALIBRATION)
        model = Regression(BUCKETS, len(names))
        for _ in range(EPOCHS):
            for i in np.flatnonzero(~check):
                model.step(*found[i], labels[i])
        w = model.weights(slice(None))
        held = np.flatnonzero(check)
        temperature = 1.0
        if len(held):
            logits = np.array([found[i][1] @ w[found[i][0]] + w[-1] for i in held])
            temperature = best_temperature(logits, labels[held])
        folded = (w[:-1] * (idf * scale)[:, None]).astype(np.float64)
        return pd.DataFrame({
            "languages": [names], "weights": [folded.tobytes()], "bias": [w[-1].tobytes()], "temperature": [temperature],
        })

    return run


def train(rows: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on ``rows``, all of which may be learned from; None when none has a language and a text."""
    known = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col).alias("h")
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    frequencies = known.select("text").mapInArrow(_frequencies, "bucket bigint, df bigint")
    frequencies = frequencies.groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()  # BUCKETS rows at most
    df = np.zeros(BUCKETS)
    df[frequencies["bucket"]] = frequencies["df"]
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1.0, max_rows / n)).otherwise(share)
    sample = known.where(F.col("h").cast("double") / 2.0**64 + 0.5 < share)
    sparse = sample.mapInArrow(_sparse, "lang string, h bigint, at binary, value binary")
    fitted = sparse.groupBy().applyInPandas(
        _fit(idf), "languages array<string>, weights binary, bias binary, temperature double"
    ).first()
    if fitted is None:
        return None
    names = list(fitted["languages"])
    return Model(
        names, np.frombuffer(bytes(fitted["weights"])).reshape(BUCKETS, len(names)).astype(np.float32),
        np.frombuffer(bytes(fitted["bias"])), fitted["temperature"],
    )


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    asked = docs.select(F.col(text_col).alias("__text"), *others)
    if model is None:
        return asked.drop("__text").withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            named, scores = [], []
            for first, end in pieces(batch.column(0)):
                p, counts = model.probabilities(batch.column(0).slice(first, end - first).to_pylist())
                best = p.argmax(axis=1)
                named += [model.languages[b] if c else UNDETERMINED for b, c in zip(best, counts, strict=True)]
                scores += np.where(counts > 0, p[np.arange(len(best)), best], 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(named, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[1:], "lang_pred", "score"],
            )

    out = asked.drop("__text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return asked.mapInArrow(run, out)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; learns from rows that are not held out only."""
    fold = held_out(F.col(id_col))
    model = train(docs.where(~fold), id_col, text_col, lang_col, max_rows)
    return predict(docs.select(id_col, fold.alias("held_out"), text_col), model, text_col)
