"""Benchmark leaks against windows compared in Python."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from nestmeans.llm import decontaminate as D
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def weights(ws):
    if len(ws) < 5:
        return collections.Counter([tuple(ws)] if ws else [])
    return collections.Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))


def similarity(a, b):
    common = sum((a & b).values())
    return common / max(1, sum(a.values()) + sum(b.values()) - common)


def brute(docs, items):
    """{(doc, item)} with a window of the item's size that is similar enough, any place."""
    found = set()
    for d, text in docs:
        ws = words(text)
        for i, item in items:
            it = words(item)
            w = weights(it)
            if not it or not set(w) & set(weights(ws) if len(it) >= 5 else [tuple(ws[k:k + len(it)]) for k in range(len(ws))]):
                continue
            if any(similarity(weights(ws[s:s + len(it)]), w) >= 0.75 for s in range(max(1, len(ws) - len(it) + 1))):
                found.add((d, i))
    return found


def answer(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert want and answer(QUERIES["op3_decontaminate"](spark, DATA)) == want


def test_near_copies_and_edges(spark):
    rnd = random.Random(1)
    word = lambda: f"w{rnd.randrange(5000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 8, 20, 40, 40, 60])]
    items += [(20, None), (21, "?!"), (22, "la " * 30), (6, items[6][1])]
    docs = []
    for i, text in items[4:9]:
        ws = text.split()
        docs.append(f"{word()} {text.upper().replace(' ', ', ')}. {word()}")
        for edits in (1, 2, 12):
            changed = list(ws)
            for _ in range(edits):
                changed[rnd.randrange(len(changed))] = word()
            docs.append(" ".join([word() for _ in range(30)] + changed))
            docs.append(" ".join(changed[2:]))
    docs += [items[0][1], items[1][1] + " z", f"a {items[2][1]}", items[3][1], "la la la " * 12, "", None, "x " * 60000, "la la"]
    rows = [(i, t, "k") for i, t in enumerate(docs)] + [(0, docs[0], "k"), (None, items[5][1], "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute([(a, b) for a, b, _ in rows], items)
    got = D.leaks(df, bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(got) == len(found) and found <= want
    assert found == want
    assert (0, 4) in found and (None, 5) in found
    kept = D.without_leaks(df, bench)
    gone = {d for d, _ in found}
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _, _ in rows if i not in gone]


def test_multi_index_finds_all_within_radius(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) - (1 << 63) for _ in range(5)]
    near = []
    for k, x in enumerate(base):
        for d in range(0, 25):
            y = x & (1 << 64) - 1
            for b in rnd.sample(range(64), d):
                y ^= 1 << b
            near.append((k, d, y - (1 << 64) if y >> 63 else y))
    a = spark.createDataFrame([(k, x) for k, x in enumerate(base)], "k int, x bigint")
    b = spark.createDataFrame(near, "k int, d int, y bigint")
    a = a.select("k", "x", F.explode(D.block_keys(F.col("x"), D.BLOCKS, D.RADIUS // D.BLOCKS)).alias("key"))
    b = b.select("k", "d", "y", F.explode(D.block_keys(F.col("y"), D.BLOCKS, 0)).alias("key"))
    met = {(r["k"], r["d"]) for r in a.join(b, ["k", "key"]).collect()}
    assert {(k, d) for k in range(5) for d in range(D.RADIUS + 1)} <= met


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    assert D.leaks(docs, some).count() == 0
    assert D.leaks(some.withColumnRenamed("item_id", "doc_id"), bench).count() == 0


def test_reordered_and_shifted_items(spark):
    rnd = random.Random(3)
    item = [f"w{i}" for i in range(100)]
    pad = lambda n: [f"p{rnd.randrange(9999)}" for _ in range(n)]
    docs = [
        pad(40) + item[50:] + item[:50] + pad(40),  # halves swapped
        pad(40) + item[33:66] + item[:33] + item[66:] + pad(40),  # sentences moved
        item[:30] + pad(3) + item[30:70] + item[73:] + pad(5),  # an insertion and a deletion
        item[80:] + item[:80],
        pad(300),
    ]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    bench = [(7, " ".join(item)), (8, " ".join(pad(20)))]
    want = brute(rows, bench)
    assert want == {(i, 7) for i in range(4)}
    got = D.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))
    assert answer(got) == want


def test_index_selects_among_many_items_of_one_size(spark):
    """10,000 items of 30 words with common passages: hardly any (window, item) pair leaves the index."""
    rnd = random.Random(4)
    common = [" ".join(f"c{rnd.randrange(300)}" for _ in range(8)) for _ in range(5)]
    items = [(i, " ".join(f"w{rnd.randrange(4000)}" for _ in range(22)) + " " + common[i % 5]) for i in range(10_000)]
    docs = [(i, " ".join(f"w{rnd.randrange(4000)}" for _ in range(60)) + " " + common[i % 5] + " " + items[i][1]) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    table = D.item_table(bench, "item_id", "text", 5)
    windows = D.candidate_windows(df, table, "doc_id", "text", 5, 0.75, D.MAX_BROADCAST)
    places = sum(len(words(t)) - 29 for _, t in docs)
    assert windows.count() < 0.05 * places * len(items)
    assert D.within_radius(windows, table, D.RADIUS, D.BLOCKS).count() < 0.001 * places * len(items)
    assert {(i, i) for i in range(40)} <= answer(D.leaks(df, bench))


def test_simhash_and_block_keys(spark):
    rnd = random.Random(5)
    lists = [[(rnd.getrandbits(64) - (1 << 63), rnd.randrange(1, 4)) for _ in range(n)] for n in (1, 2, 7, 40)]
    df = spark.createDataFrame([(w,) for w in lists], "w array<struct<s:bigint,c:int>>")
    for r, w in zip(df.select(D.simhash(F.col("w")).alias("h")).collect(), lists):
        bits = [sum(c for s, c in w if s >> b & 1) * 2 > sum(c for _, c in w) for b in range(64)]
        assert r["h"] & (1 << 64) - 1 == sum(1 << b for b, on in enumerate(bits) if on)
    x = rnd.getrandbits(64)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,)], "x bigint")
    got = {(k["block"], k["value"]) for k in df.select(D.block_keys(F.col("x"), 9, 2).alias("k")).first()["k"]}
    want = set()
    for number, (start, bits) in enumerate(D._block_spans(9)):
        value = x >> start & (1 << bits) - 1
        want |= {(number, value ^ mask) for mask in range(1 << bits) if mask.bit_count() <= 2}
    assert got == want
