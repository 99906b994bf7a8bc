"""Vector codes against plain rounds in unlimited integers, and against SQL."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as entry_point
from compare import DATA, difference, duck, duck_rows, spark_rows, type_difference
from nestmeans.llm import vector_codes as V
from nestmeans.llm.queries import QUERIES


def brute(rows, parts=4, entries=256, rounds=4):
    """rows of (id, label, vector); sorted result rows of the query"""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    ints = [[(a * 1024) // b for a, b in (float(x).as_integer_ratio() for x in r[2])] for r in kept]
    size = len(ints[0]) // parts if ints else 0
    cut = [[v[p * size:(p + 1) * size] for v in ints] for p in range(parts)]
    books = [c[:entries] for c in cut]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book)) for v in own] for own, book in zip(cut, books)]

    for _ in range(rounds):
        near = assign()
        for p, own in enumerate(cut):
            groups = {}
            for v, (_, e) in zip(own, near[p]):
                groups.setdefault(e, []).append(v)
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else c for e, c in enumerate(books[p])]
    near = assign()
    told = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(near[p][i][0] for p in range(parts)) for i in range(len(kept))]
    labels = {}
    for r, e in zip(kept, errors):
        labels.setdefault(r[1], []).append(e)
    long = lambda e: e if e < 1 << 63 else None
    total = {k: long(sum(v)) if all(e < 1 << 63 for e in v) else None for k, v in labels.items()}
    out = [(r[0], "".join(f"{near[p][i][1]:02x}" for p in range(parts)), long(errors[i]), total[r[1]], told) for i, r in enumerate(kept)]
    return sorted(out, key=str)


def run(spark, rows, kind="float", **settings):
    df = spark.createDataFrame(rows, f"vec_id bigint, label int, embedding array<{kind}>").repartition(3)
    return sorted([tuple(r) for r in V.coded(df, **settings).collect()], key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, folder):
    folder = f"{DATA}/{folder}"
    df, sql = QUERIES["op13_vector_codes"](spark, folder), entry_point.oracle_sql()["op13_vector_codes"]
    con = duck(folder)
    assert type_difference(df, con, sql) is None
    assert difference(spark_rows(df), duck_rows(con, sql)) is None


@pytest.mark.parametrize("first_list", [1, 2, 7, 32, 40])
def test_lists_of_any_length(spark, first_list):
    rng = np.random.default_rng(first_list)
    rows = [(i, int(i % 3), [float(x) for x in rng.normal(0, 1, 8) + 3 * (i % 5)]) for i in range(400)]
    assert run(spark, rows, "double", entries=40, first_list=first_list) == brute(rows, entries=40)


def test_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i // 2, None if i % 4 else 1, [float(x) / 1024 for x in rng.integers(-2, 3, 8)]) for i in range(300)]
    rows += [(5, 2, [0.0] * 8)] * 200
    assert run(spark, rows, entries=16, first_list=3) == brute(rows, entries=16)


def test_bounds_spare_most_of_the_work(spark):
    rng = np.random.default_rng(1)
    heart = rng.normal(0, 1, (64, 8))
    rows = [(i, 0, [float(x) for x in heart[i % 64] + rng.normal(0, 0.02, 8)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    codes = V.compress(df, entries=64)
    assert codes.measured[0] == 64 and max(codes.measured[1:]) < 12
    assert min(min(x) for x in codes.lists) < 32


@pytest.mark.parametrize("kind, top", [("float", 1e30), ("double", 1.7e308), ("double", 5e4)])
def test_components_of_any_size(spark, kind, top):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, [float(np.float32(x) if kind == "float" else x) for x in rng.uniform(-1, 1, 4) * (top if i % 3 else 1e-3)]) for i in range(90)]
    assert run(spark, rows, kind, entries=9, first_list=2) == brute(rows, entries=9)


def test_edge_tables(spark):
    rows = [(1, 1, None), (2, None, [1.0, None, 0.0, 0.0]), (3, 1, [float("nan"), 0.0, 0.0, 0.0]), (4, 1, [0.0, float("inf"), 0.0, 0.0]),
            (None, None, [0.5, -0.5, 0.25, 1.0]), (None, None, [0.5, -0.5, 0.25, 1.0]), (7, None, [1.0, 2.0, 3.0, -4.0])]
    assert run(spark, rows) == brute(rows) and len(brute(rows)) == 3
    assert run(spark, rows[:4]) == [] and run(spark, []) == []
    assert run(spark, [(1, 1, []), (2, 1, [])]) == brute([(1, 1, []), (2, 1, [])])
    with pytest.raises(ValueError, match="one width"):
        run(spark, [(1, 1, [1.0] * 4), (2, 1, [1.0] * 8)])
    with pytest.raises(ValueError, match="divides"):
        run(spark, [(1, 1, [1.0] * 6)])
    names = "vec_id bigint, label int, embedding array<float>, id string, vector string, code string, state int, error string, of int"
    wide = [(1, 1, [1.0] * 4, "a", "b", "c", 2, "d", 3)]
    assert [r["code"] for r in V.coded(spark.createDataFrame(wide, names)).collect()] == ["00000000"]
