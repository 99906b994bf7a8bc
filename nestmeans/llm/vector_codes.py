"""Short codes for vectors: every part of a vector is replaced by the nearest entry of the part's codebook.

Codebooks are trained by rounds of assigning and averaging, in integers, so each value is exact and the same for
every partitioning. Assigning uses adaptive distance bounds: a row keeps, for each of its parts, its ``b``
closest entries in order, with a lower bound of the distance to each and one outer bound for all entries not listed.
When the codebook has moved, every bound falls by how far its entry moved (the outer one by the
largest move) and is capped by the bound after it. The exact distance to the row's own entry then tells how many listed entries are
still in question: usually none but its own. Only those are measured, in integers, ties going to the lower
index; the whole codebook only where the outer bound is in question too. Bounds are floating and rounded away from the truth by
more than the error of the arithmetic, so they never decide a case that integers would decide otherwise. After each round ``b`` of each part
position becomes the shortest list that holds nearly all of the entries in question: shorter lists are
cut, longer ones filled up as rows are measured anew.

Rows with their bounds are written once per round to the shared folder and the round before is dropped, so a lost
executor repeats one task. A task holds one Arrow batch in blocks of ``BLOCK`` rows. Sums leave a task
as one row for each entry that occurs there and are merged by (part, entry) in tasks of the next stage; only the
codebook, ``entries * width`` integers, comes to the driver and goes back to the tasks.

Defined cases: rows whose vector is NULL or holds NULL or non-finite components are dropped; fewer rows than entries
make a smaller codebook; NULL ids come last where the first rows are chosen, and rows equal in id are taken in
the order of their vectors; an empty table gives an empty result; vectors of different widths, or of one that the
parts do not divide, are an error that tells them; components of any finite size are exact (integers without a limit where
64 bits do not hold them); an error beyond BIGINT is NULL and so is the sum over its label. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmeans.scratch import Stored, materialize, store

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
FIRST_LIST = 32
LEAST_LIST = 2
# The share of rows whose entries in question shall fit into their lists.
COVERED = 0.98
BLOCK = 4096
_SLACK = 1e-9
_LONG = 1 << 63
_HUGE = 10**300

_MOVED = "part int, entry int, need int, n bigint, sums array<string>"


# --- integers ---------------------------------------------------------------------------------


def _fits(top, width: int) -> bool:
    """Whether squared distances of integers up to ``top``, times the entries of a codebook, hold in 63 bits."""
    return 4 * top * top * max(1, width) < 1 << 54


def to_integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as unlimited integers where their squares would not fit.

    ``scale`` is a power of two, so the product is exact.
    """
    top = float(np.abs(vectors).max(initial=0))
    if top < 1 << 40 and _fits(int(top * scale) + 1, vectors.shape[1]):
        return np.floor(vectors * scale).astype(np.int64)
    ratios = [x.as_integer_ratio() for x in vectors.ravel().tolist()]
    return np.array([a * scale // b for a, b in ratios], dtype=object).reshape(vectors.shape)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c``."""
    if x.dtype == object or c.dtype == object:
        x, c = x.astype(object), c.astype(object)
        return (x * x).sum(axis=1)[:, None] - 2 * x.dot(c.T) + (c * c).sum(axis=1)[None, :]
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, c = x.astype(kind), c.astype(kind)
    found = np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ c.T) + np.einsum("ij,ij->i", c, c)[None, :]
    return found.astype(np.int64)


def paired(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row ``i`` of ``x`` to ``c[i]`` or to each of ``c[i, :]``."""
    if c.ndim == 3:
        x = x[:, None, :]
    gap = x.astype(object) - c.astype(object) if x.dtype == object or c.dtype == object else x - c
    return (gap * gap).sum(axis=-1)


def _roots(distances: np.ndarray, beyond: float) -> np.ndarray:
    """Square roots; ``beyond`` for those that no float holds."""
    if distances.dtype != object:
        return np.sqrt(distances.astype(np.float64))
    roots = [math.isqrt(int(d)) for d in distances.ravel()]
    return np.array([float(r) if r < _HUGE else beyond for r in roots], dtype=np.float64).reshape(distances.shape)


def below(distances: np.ndarray) -> np.ndarray:
    """Float32 lower bounds of the roots of exact squares."""
    roots = np.minimum(_roots(distances, float(_HUGE)) * (1 - _SLACK), np.finfo(np.float32).max)
    return np.nextafter(roots.astype(np.float32), np.float32(-np.inf))


def above(distances: np.ndarray) -> np.ndarray:
    """Upper bounds of the roots of exact squares."""
    spare = 1.0 if distances.dtype == object else 0.0
    return (_roots(distances, np.inf) + spare) * (1 + _SLACK)


# --- bounds -----------------------------------------------------------------------------------


def _ranked(distances: np.ndarray, index: np.ndarray, entries: int) -> np.ndarray:
    """A key that orders by distance, then by index of the entry."""
    return distances * entries + index


def measure(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(near, low, distance)`` from all entries: the ``b`` closest in order, their bounds and the outer one."""
    k = len(book)
    keys = _ranked(squares(x, book), np.arange(k), k)
    if b < k:
        keys = np.partition(keys, b, axis=1)[:, : b + 1]
    keys = np.sort(keys, axis=1)
    near = (keys % k).astype(np.uint8)
    low = below(keys // k)
    if b >= k:
        low = np.concatenate([low, np.full((len(x), 1), np.inf, np.float32)], axis=1)
    return near[:, :b], low, keys[:, 0] // k


def resized(near: np.ndarray, low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ``b`` entries: cut, with the first one cut away as outer bound, or filled up with the own entry,
    which stands beyond the outer bound and so is never looked at."""
    have = near.shape[1]
    if b <= have:
        return near[:, :b], low[:, : b + 1]
    more = b - have
    return np.concatenate([near, np.repeat(near[:, :1], more, axis=1)], axis=1), np.concatenate([low, np.repeat(low[:, -1:], more, axis=1)], axis=1)


def reassign(
    x: np.ndarray, book: np.ndarray, drift: np.ndarray, near: np.ndarray, low: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(near, low, distance, need)`` after the codebook has moved by ``drift``.

    ``need`` is the number of listed entries that were in question, ``len(book)`` where the outer bound was.
    """
    k, b = len(book), near.shape[1]
    fall = np.concatenate([drift[near], np.full((len(x), 1), drift.max())], axis=1)
    # an infinite bound stands for no entry at all and stays
    fallen = np.maximum(low.astype(np.float64) - np.where(np.isinf(low), 0, fall), -np.finfo(np.float32).max)
    low = np.where(np.isposinf(low), low, np.nextafter(fallen.astype(np.float32), np.float32(-np.inf)))
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].copy()  # ordered: none above the one after it
    near = near.copy()
    distance = paired(x, book[near[:, 0]])
    own = above(distance)[:, None]
    # the own entry is always in question, so counting starts at the second
    need = 1 + (low[:, 1:] <= own).sum(axis=1)
    wide = need > b
    low[:, 0] = np.minimum(below(distance), low[:, 1])
    if wide.any():
        near[wide], low[wide], distance[wide] = measure(x[wide], book, b)
    some = np.flatnonzero((need > 1) & ~wide)
    some = some[np.argsort(need[some], kind="stable")]
    for start in range(0, len(some), BLOCK):
        rows = some[start : start + BLOCK]
        m = int(need[rows[-1]])
        listed = near[rows, :m]
        keys = _ranked(paired(x[rows], book[listed]), listed.astype(np.int64), k)
        asked = np.arange(m) < need[rows][:, None]
        beyond = keys.max() + 1 if keys.dtype == object else np.iinfo(np.int64).max
        order = np.argsort(np.where(asked, keys, beyond), axis=1, kind="stable")
        keys, listed = np.take_along_axis(keys, order, axis=1), np.take_along_axis(listed, order, axis=1)
        near[rows, :m] = listed
        held = low[rows]
        held[:, :m] = np.where(asked, below(keys // k), held[:, :m])
        low[rows] = np.minimum.accumulate(held[:, ::-1], axis=1)[:, ::-1]
        distance[rows] = keys[:, 0] // k
    return near, low, distance, np.where(wide, k, need)


# --- tasks ------------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _packed(near: list[np.ndarray], low: list[np.ndarray]) -> pa.Array:
    """One binary value a row: for each part its entries, then its bounds."""
    pieces = [p for a, b in zip(near, low) for p in (a, np.ascontiguousarray(b).view(np.uint8).reshape(len(b), -1))]
    whole = np.ascontiguousarray(np.concatenate(pieces, axis=1))
    return pa.Array.from_buffers(pa.binary(whole.shape[1]), len(whole), [None, pa.py_buffer(whole.tobytes())]).cast(pa.binary())


def _unpacked(column: pa.Array, lists: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    wide = sum(5 * b + 4 for b in lists)
    whole = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), wide)
    near, low, at = [], [], 0
    for b in lists:
        near.append(whole[:, at : at + b])
        low.append(np.ascontiguousarray(whole[:, at + b : at + 5 * b + 4]).view(np.float32))
        at += 5 * b + 4
    return near, low


def _assigner(width: int, parts: int, shared, drifts, held: list[int] | None, lists: list[int]):
    """The map of one round: bounds in, bounds out. ``shared`` broadcasts the codebooks, ``held`` are the lists that come in."""
    size = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                n = piece.num_rows
                x = to_integers(_matrix(piece.column("vector"), width))
                old = _unpacked(piece.column("state"), held) if held else None
                near, low, needs, errors = [], [], [], np.zeros(n, object)
                for p in range(parts):
                    own, book = x[:, p * size : (p + 1) * size], books[p]
                    if old is None:
                        a, b, d = measure(own, book, lists[p])
                        need = np.full(n, len(book))
                    else:
                        a, b, d, need = reassign(own, book, drifts[p], *resized(old[0][p], old[1][p], lists[p]))
                    near.append(a)
                    low.append(b)
                    needs.append(need)
                    errors = errors + d
                code = np.stack([a[:, 0] for a in near], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"), piece.column("label"), piece.column("vector"), _packed(near, low),
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(list(np.stack(needs, axis=1).astype(np.int32)), pa.list_(pa.int32())),
                        pa.array([int(e) if e < _LONG else None for e in errors], pa.int64()),
                    ],
                    ["id", "label", "vector", "state", "code", "need", "error"],
                )

    return run


def _summer(width: int, parts: int):
    """Per task: rows and sums of every entry that occurs, and how often each number of entries was in question."""
    size = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        needs: dict[tuple[int, int], int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                x = to_integers(_matrix(piece.column("vector"), width))
                code = np.frombuffer(b"".join(piece.column("code").to_pylist()), np.uint8).reshape(piece.num_rows, parts)
                need = piece.column("need").flatten().to_numpy().reshape(piece.num_rows, parts)
                for p in range(parts):
                    order = np.argsort(code[:, p], kind="stable")
                    entries, first, counts = np.unique(code[order, p], return_index=True, return_counts=True)
                    for e, n, total in zip(entries, counts, np.add.reduceat(x[order, p * size : (p + 1) * size], first, axis=0)):
                        held = sums.setdefault((p, int(e)), [0, [0] * size])
                        held[0] += int(n)
                        held[1] = [a + int(b) for a, b in zip(held[1], total)]
                    for v, n in zip(*np.unique(need[:, p], return_counts=True)):
                        needs[p, int(v)] = needs.get((p, int(v)), 0) + int(n)
        yield _summary(sums, needs)

    return run


def _summary(sums: dict, needs: dict) -> pa.RecordBatch:
    rows = [(p, e, None, n, [str(t) for t in total]) for (p, e), (n, total) in sums.items()]
    rows += [(p, None, v, n, None) for (p, v), n in needs.items()]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["part", "entry", "need", "n", "sums"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows that tasks sent for the same entry."""
    sums: dict[tuple[int, int], list] = {}
    needs: dict[tuple[int, int], int] = {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["entry"] is None:
                needs[r["part"], r["need"]] = needs.get((r["part"], r["need"]), 0) + r["n"]
            else:
                held = sums.setdefault((r["part"], r["entry"]), [0, [0] * len(r["sums"])])
                held[0] += r["n"]
                held[1] = [a + int(b) for a, b in zip(held[1], r["sums"])]
    yield _summary(sums, needs)


# --- driver -----------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _book(rows: list[list[int]], size: int) -> np.ndarray:
    """Entries as int64 where their squares fit, else as unlimited integers."""
    top = max((abs(v) for r in rows for v in r), default=0)
    return np.array(rows, dtype=np.int64 if _fits(top, size) else object).reshape(len(rows), size)


def _next_lists(needs: dict[int, dict[int, int]], lists: list[int], entries: int) -> list[int]:
    """For each part position the shortest list that holds what was in question for the share ``COVERED`` of the
    rows; twice the list where too many rows went beyond it."""
    out = []
    for p, b in enumerate(lists):
        left, total, fit = sum(needs[p].values()), 0, None
        for need in sorted(needs[p]):
            total += needs[p][need]
            if total >= COVERED * left:
                fit = need
                break
        fit = 2 * b if fit is None or fit > b else max(LEAST_LIST, fit)
        out.append(min(fit, entries))
    return out


class Codes:
    """``frame`` (id, label, code, error), the final ``books`` (parts x entries x width) and, per round, the lists'
    lengths and the mean number of entries measured for a part."""

    def __init__(self, frame: DataFrame, books: list[np.ndarray], lists: list[list[int]], measured: list[float]):
        self.frame, self.books, self.lists, self.measured = frame, books, lists, measured

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
        values = [str(int(v)) for book in self.books for entry in book for v in entry]
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, first_list: int = FIRST_LIST,
) -> Codes:
    """Codes of all usable vectors, a byte for each part, after ``rounds`` rounds of training on all of them."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be in 1..256, as a code has one byte for each part")
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    kept = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(kind).alias("vector")
    ).where(usable(F.col("vector")))
    low, high = kept.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    width = low or 0
    if low != high or width % parts:
        raise ValueError(f"vectors need one width that {parts} divides; found {low} to {high}")
    size = width // parts
    first = kept.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    start = to_integers(np.array([r["vector"] for r in first], dtype=np.float64).reshape(len(first), width))
    books = [_book([[int(v) for v in r[p * size : (p + 1) * size]] for r in start], size) for p in range(parts)]
    schema = (f"id {kept.schema['id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}, "
              f"vector {kind}, state binary, code binary, need array<int>, error bigint")
    k = len(first)
    lists = [max(1, min(first_list, k))] * parts
    held: list[int] | None = None
    drifts, rows, old = None, kept, None
    told, measured = [], []
    for turn in range(rounds + 1):
        shared = spark.sparkContext.broadcast(books)
        new: Stored = store(rows.mapInArrow(_assigner(width, parts, shared, drifts, held, lists), schema), "codes")
        if old is not None:
            old.drop()
        old, rows, held = new, new.frame, lists
        told.append(lists)
        if turn == rounds or not k:
            break
        partial = rows.select("vector", "code", "need").mapInArrow(_summer(width, parts), _MOVED)
        found = partial.repartition("part", "entry", "need").mapInArrow(_merge, _MOVED).collect()
        needs = {p: {} for p in range(parts)}
        moved = [[[int(v) for v in e] for e in book] for book in books]
        for r in found:  # at most parts * (2 * entries + 1) rows
            if r["entry"] is None:
                needs[r["part"]][r["need"]] = r["n"]
            else:
                moved[r["part"]][r["entry"]] = [int(t) // r["n"] for t in r["sums"]]
        count = sum(needs[0].values())
        measured.append(sum(v * n for p in needs.values() for v, n in p.items()) / max(1, count * parts))
        before, books = books, [_book(b, size) for b in moved]
        drifts = [above(paired(a, b)) for a, b in zip(before, books)]
        if turn:
            lists = _next_lists(needs, lists, k)
        shared.unpersist()
    return Codes(rows.select("id", "label", "code", "error"), books, told, measured)


def coded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **settings) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)`` of all usable vectors; ``code`` as hexadecimal digits."""
    codes = compress(vectors, id_col, vector_col, label_col, **settings)
    whole = F.count(F.lit(1)) == F.count("error")
    totals = codes.frame.groupBy("label").agg(F.when(whole, F.try_sum("error")).alias("label_error"))
    totals = materialize(totals.withColumnRenamed("label", "of"), "label-errors")
    found = codes.frame.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
    return found.select(
        F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")
    )
