"""The manifest against a tree built in Python, and against its SQL."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import DATA, difference, duck, duck_rows, spark_rows, type_difference
from nestmeans.llm import manifest as M
from nestmeans.llm.queries import QUERIES

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def fold(s):
    return s and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def climb(nodes, arity):
    """(what remains, [siblings before and after of each level] of every node)"""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
        for i, path in enumerate(paths):
            run, slot = runs[at[i] // arity], at[i] % arity
            path.append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[i] //= arity
        nodes = [H(*run) for run in runs]
    return nodes[0], paths


def brute(rows, arity=8):
    groups = collections.defaultdict(list)
    for r in rows:
        leaf = H(*[enc(r[c]) for c in COLUMNS])
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g], key=lambda x: x[:3])
        trees.append((members, *climb([m[2] for m in members], arity)))
    root, above = climb([t[1] for t in trees], arity)
    out = []
    for (members, subroot, paths), upper in zip(trees, above):
        for (_, _, leaf, r), path in zip(members, paths):
            cur = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                cur = H(*[enc(fold(r[c]) if c == "text" else r[c]) for c in COLUMNS])
            for before, after in path + upper:
                cur = H(before, cur, after)
            out.append((r["doc_id"], leaf, subroot, root, H(*[b + a for b, a in path + upper]), cur, cur == root))
    return sorted(out, key=str)


def query(df, arity=8):
    """As the query does, on any rows and of any arity."""
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
                     M.leaf_of([F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c == "text" else F.col(c) for c in COLUMNS]))
    found = M.manifest(df, COLUMNS, arity=arity, others={"changed": changed}).select(
        "doc_id", "leaf", "subroot", "root", M.proof(F.col("path")), M.folded(F.coalesce("changed", "leaf"), F.col("path")).alias("f"))
    return sorted([tuple(r) + (r["f"] == r["root"],) for r in found.collect()], key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql_and_brute_force(spark, folder):
    folder = f"{DATA}/{folder}"
    df, sql = QUERIES["op12_manifest"](spark, folder), entry_point.oracle_sql()["op12_manifest"]
    con = duck(folder)
    assert type_difference(df, con, sql) is None
    rows = spark_rows(df)
    assert difference(rows, duck_rows(con, sql)) is None
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute([r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    assert sorted([tuple(r[rows[0].index(n)] for n in names) for r in rows[1]], key=str) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("arity, counts", [(8, {"a": 1, "b": 8, "c": 9, None: 65, "": 2}), (2, {"a": 1, "b": 2, "c": 3, "d": 37, None: 5}),
                                            (3, {"a": 28}), (8, {"only": 1}), (8, {f"g{i}": 1 + i % 3 for i in range(70)})])
def test_shapes(spark, arity, counts):
    rows = [(i * 7 % 1009, f"Text {i}", g, None, i) for i, g in enumerate(g for g, n in counts.items() for _ in range(n))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert query(df, arity) == brute([r.asDict() for r in df.collect()], arity)


def test_edge_tables(spark):
    same = (7, "Same TEXT é€𝄞", "en", "s", 3)
    rows = [same] * 40 + [(None, None, None, None, None)] * 3 + [(1, "", "en", "", 0), (2, "X" * 300000, "", "s", -5), (7, "other", "en", "s", 1)]
    names = SCHEMA.replace("doc_id bigint", "doc_id bigint, grp int, idx int, n string, node string, salt string, path string")
    wide = [(r[0], 1, 2, "x", "y", "z", "p", *r[1:]) for r in rows]
    df = spark.createDataFrame(wide, names)
    assert query(df) == brute([r.asDict() for r in df.collect()])
    assert query(spark.createDataFrame([], SCHEMA)) == []
    with pytest.raises(ValueError):
        M.manifest(df, COLUMNS, arity=1)
