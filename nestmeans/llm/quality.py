"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's features are its words and the 1- to 3-grams of its characters' classes (letters and
digits as kinds, other bytes as they are), hashed to columns, and columns that tell how often a
word repeats the one before it and how many words are new. Log counts times inverse document
frequency, scaled to unit length, are projected to ``DIMS`` latent-semantic axes. Each
document is compared with all labelled vectors in exact blocked cosine products; its ``NEIGHBOURS``
nearest vote with their labels, weighted by similarity.

Document frequencies come from all documents. The axes and the voters are fitted on a bounded
sample of labelled rows: about ``max_rows`` of each label by a hash of the id, which also bounds what
is broadcast. Scoring is map-only over whole texts.

Defined cases: a text without a word scores 0; NULL texts are empty; without any labelled row every
score is 0; ids with several labels vote with each; repeated rows get the same score; ties between
neighbours go to the smaller id hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.llm import words as W
from nestmeans.llm.common import held_out

WORD_BUCKETS, CLASS_BUCKETS, STEPS = 1 << 12, 1 << 11, 16
REPEATS = WORD_BUCKETS + CLASS_BUCKETS
FEATURES = REPEATS + 2 * STEPS
DIMS = 64
NEIGHBOURS = 15
MAX_ROWS = 2000
THRESHOLD = 0.7
PIECE = 1 << 19

# Character classes: lower and other letters, upper case, digits, blanks; other bytes stay.
CLASSES = np.arange(256)
CLASSES[97:123] = 97
CLASSES[128:] = 97
CLASSES[65:91] = 65
CLASSES[48:58] = 48
CLASSES[[32, 9]] = 32
CLASSES = (CLASSES + 1).astype(np.uint64)


def counts_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(texts x FEATURES counts, words of each text)`` of one piece."""
    n = len(bounds) - 1
    word, row = W.word_hashes(data, bounds)
    keys = [row * FEATURES + (word & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)]
    lead = (data & 0xC0) != 0x80  # continuation bytes are no characters
    owner = np.repeat(np.arange(n), np.diff(bounds))[lead]
    kind = CLASSES[data[lead]]
    total = np.zeros(len(kind), np.uint64)
    for order in (1, 2, 3):
        size = len(kind) - order + 1
        if size <= 0:
            break
        total = total[:size] * np.uint64(257) + kind[order - 1:]
        bucket = (W.mix(total + np.uint64(order << 40)) & np.uint64(CLASS_BUCKETS - 1)).astype(np.int64)
        whole = owner[:size] == owner[order - 1:]
        keys.append((owner[:size] * FEATURES + WORD_BUCKETS + bucket)[whole])
    counts = np.bincount(np.concatenate(keys), minlength=n * FEATURES).reshape(n, FEATURES)[:, :FEATURES].astype(np.float32)
    words = np.bincount(row, minlength=n)
    if len(row):
        again = np.bincount(row[1:], (word[1:] == word[:-1]) & (row[1:] == row[:-1]), minlength=n)
        fresh = np.bincount(W.distinct(word, row)[1], minlength=n)
        for place, share in ((0, again / np.maximum(words, 1)), (1, fresh / np.maximum(words, 1))):
            step = np.minimum((share * STEPS).astype(np.int64), STEPS - 1)
            at = np.flatnonzero(words)
            # as heavy as the whole text, since every word says so
            counts[at, REPEATS + place * STEPS + step[at]] = words[at]
    return counts, words


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    text = batch.column(0)
    for first, end in W.pieces(text, PIECE):
        while first < end:  # bound the dense counts as well
            last = min(end, first + 256)
            yield first, last, *counts_of(*W.text_bytes(text, first, last))
            first = last


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, np.int64)
    for batch in batches:
        for _, _, counts, _ in _texts(batch):
            total += (counts > 0).sum(axis=0)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "df"])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts times idf, of unit length."""
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    """Latent axes and the labelled vectors."""

    idf: np.ndarray
    axes: np.ndarray  # FEATURES x dims
    vectors: np.ndarray  # voters x dims, unit length
    labels: np.ndarray
    weights: np.ndarray  # what a voter of each label counts, for labels sampled at different rates

    def scores(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = unit(weighted(counts, self.idf) @ self.axes)
        near = z @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(z), 1))
        votes = np.maximum(np.take_along_axis(near, at, axis=1), 1e-6).astype(np.float64) * self.weights[at]
        share = (votes * self.labels[at]).sum(axis=1) / votes.sum(axis=1)
        return np.where(words > 0, np.clip(share, 0, 1), 0.0)


def unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def latent_axes(x: np.ndarray, dims: int, seed: int = 0) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration."""
    rng = np.random.default_rng(seed)
    dims = min(dims, *x.shape)
    q = rng.standard_normal((x.shape[1], min(dims + 16, *x.shape)), dtype=np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T[:, :dims]).astype(np.float32)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, counts, words in _texts(batch):
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(first, end - first), batch.column(2).slice(first, end - first),
                    pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                    pa.array([c[a].astype(np.float32).tobytes() for c, a in zip(counts, at, strict=True)], pa.binary()),
                ],
                ["label", "h", "at", "value"],
            )


def _fit(idf: np.ndarray, dims: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["at"].str.len() > 0].sort_values(["h", "label"], ignore_index=True)
        counts = np.zeros((len(rows), FEATURES), np.float32)
        for i, (at, value) in enumerate(zip(rows["at"], rows["value"], strict=True)):
            counts[i, np.frombuffer(at, np.uint16)] = np.frombuffer(value, np.float32)
        if not len(rows):
            return pd.DataFrame(columns=["axes", "vectors", "labels"])
        x = weighted(counts, idf)
        axes = latent_axes(x, dims)
        return pd.DataFrame({
            "axes": [axes.tobytes()], "vectors": [unit(x @ axes).astype(np.float32).tobytes()],
            "labels": [rows["label"].to_numpy(np.int64).tobytes()],
        })

    return run


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_rows: int = MAX_ROWS, dims: int = DIMS,
) -> Model | None:
    """Fit on the rows of ``labels`` that are not held out; None when there are none."""
    known = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("__id"))
    usable = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    usable = usable.select(F.col(id_col).alias("__label_id"), F.col(label_col).cast("bigint").alias("label"), F.xxhash64(id_col).alias("h"))
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    rates = {k: min(1.0, max_rows / n) for k, n in sizes.items()}
    rate = F.lit(0.0)
    for label, share in rates.items():
        rate = F.when(F.col("label") == label, share).otherwise(rate)
    # about max_rows for each of two labels: a bound that does not grow with the data
    sample = F.broadcast(usable.where(F.col("h").cast("double") / 2.0**64 + 0.5 < rate))
    frequencies = known.select("text").mapInArrow(_frequencies, "feature bigint, df bigint")
    frequencies = frequencies.groupBy("feature").agg(F.sum("df").alias("df")).toPandas()  # FEATURES rows at most
    df = np.zeros(FEATURES)
    df[frequencies["feature"]] = frequencies["df"]
    total = max(1, int(df.max()))  # nearly every text has the commonest feature
    idf = (np.log((1 + total) / (1 + df)) + 0.1).astype(np.float32)
    met = known.join(sample, F.col("__id") == F.col("__label_id")).select("text", "label", "h")
    sparse = met.mapInArrow(_sampled, "label bigint, h bigint, at binary, value binary")
    fitted = sparse.groupBy().applyInPandas(_fit(idf, dims), "axes binary, vectors binary, labels binary").first()
    if fitted is None:
        return None
    labels_of = np.frombuffer(bytes(fitted["labels"]), np.int64)
    axes = np.frombuffer(bytes(fitted["axes"]), np.float32).reshape(FEATURES, -1)
    weights = np.array([1 / rates[k] for k in labels_of.tolist()])
    return Model(
        idf, axes, np.frombuffer(bytes(fitted["vectors"]), np.float32).reshape(len(labels_of), -1), labels_of, weights
    )


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "score")]
    asked = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *others)
    if model is None:
        return asked.drop("__text").withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.scores(counts, words) for _, _, counts, words in _texts(batch)]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values)], [*batch.schema.names[1:], "score"])

    return asked.mapInArrow(run, asked.drop("__text").withColumn("score", F.lit(0.0)).schema)


def grade(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = THRESHOLD, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    scored = score(docs.select(id_col, held_out(F.col(id_col)).alias("held_out"), text_col), model, text_col)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **settings) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    model = train(docs, labels, text_col=text_col, **settings)
    names = docs.columns
    scored = score(docs.withColumn("__text", F.col(f"`{text_col}`")).withColumnRenamed("score", "__score"), model, "__text")
    kept = scored.where(F.col("score") >= threshold).drop("score").withColumnRenamed("__score", "score")
    return kept.select(*[F.col(f"`{c}`") for c in names])
