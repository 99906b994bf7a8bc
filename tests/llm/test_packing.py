"""Packing checked against whole-text tokenization and its own rules."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nestmeans.llm import packing
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.tokenizer_path())


def verify(rows, texts, model, window=4096):
    """Every id lies in one piece, pieces are gapless, sequences full or powers of two."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    return sequences


def test_query(spark, model):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    verify(QUERIES["op5_pack"](spark, DATA).collect(), texts, model)


def test_small_shards_and_odd_texts(spark, model):
    texts = {
        1: "", 2: None, 3: "a b\x0bc\x1cd e", 4: "It's <|endoftext|> x<|startoftext|>y I'LL don't 12 3.4!?",
        5: "word " * 9000, 6: "É́ ÀÉ ́x İstanbul ΣΑΣ", 7: "汉字 😀😀 ﬁ", 8: "z" * 50000,
        **{100 + i: f"topic{i % 3} alpha beta gamma " * (i % 40) for i in range(200)},
    }
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id bigint, text string, length string").repartition(3)
    verify(packing.pack(df, shard_tokens=5000).collect(), texts, model)
    verify(packing.pack(df, window=64).collect(), texts, model, 64)


def test_neighbours_share_rare_tokens():
    rnd = np.random.default_rng(0)
    docs = [np.concatenate([rnd.integers(0, 50, 60), np.full(20, 1000 + i % 4)]).astype("<u4") for i in range(40)]
    mates = [len({1000 + d % 4 for d, _, n in w if n == 80}) for w in packing.pack_shard(docs, 400)]
    assert np.mean(mates[:6]) < 1.5


def test_scores_match_formula():
    docs = [np.array(d, "<u4") for d in ([1, 1, 2], [2, 3], [3, 3, 3, 4], [5])]
    got = packing.Index(docs).scores(0)
    mean = np.mean([len(d) for d in docs])
    for i, d in enumerate(docs):
        want = 0.0
        for t in (1, 2):
            df, tf = sum(t in x for x in docs), list(d).count(t)
            idf = np.log(1 + (4 - df + 0.5) / (df + 0.5))
            want += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        assert got[i] == pytest.approx(want)


def test_ties_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id bigint, text string").coalesce(1)
    rows = packing.pack(df).collect()
    assert sum(r["length"] for r in rows) == 9 and {r["doc_id"] for r in rows} == {1, None}
    assert packing.pack(df.limit(0)).count() == 0


def test_words_in_pieces_equal_whole_texts(model):
    rnd = random.Random(1)
    alphabet = (
        ["a", "B", "é", "É", "İ", "I", "ß", "Σ", "'s", "'", "'T", "don't", ".", "...", "!", "*#$", "_", "-", "1", "22", "½", "٣"]
        + ["<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", ">", "\u0301", "\u0307", " ", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0"]
        + ["\u200b", "…", "汉", "😀", "‘s", "`", "~", "@", "[", "^", "{", "}", "\xad", "ﬁ", "\u212a"]
    )
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(3000)]
    found = packing.Tokens(None, cached=500).encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u2").tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_topics_meet_whatever_the_files(spark, model):
    """Planted topics spread over all rows: the share of a window's ids that belong to its seed's topic does not depend
    on the order and partitions of the rows."""
    rnd = random.Random(3)
    words = sorted(w.removesuffix("</w>") for w in model.get_vocab())
    words = [w for w in words if w.isascii() and w.isalpha() and len(w) > 4 and len(model.encode(w, add_special_tokens=False).ids) == 1]
    words = rnd.sample(words, 400 + 300 * 5)
    common = words[:400]
    rows = []
    for i in range(3000):
        topic = i % 300
        text = rnd.choices(common, k=40) + rnd.choices(words[400 + 5 * topic:405 + 5 * topic], k=20)
        rnd.shuffle(text)
        rows.append((i, " ".join(text)))
    shares = []
    for seed, parts in ((1, 1), (2, 8)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        windows = collections.defaultdict(list)
        for r in packing.pack(df, window=1024, shard_tokens=20_000).collect():
            windows[r["sequence_id"]].append((r["offset"], r["doc_id"] % 300))
        same = pairs = 0
        for pieces in windows.values():
            seed_topic, *others = [t for _, t in sorted(pieces)]
            same += sum(t == seed_topic for t in others)
            pairs += len(others)
        shares.append(same / pairs)
    assert min(shares) > 0.2 and abs(shares[0] - shares[1]) < 0.05, shares


def test_equal_documents_spread_over_tasks(spark):
    df = spark.createDataFrame([(i, "one text of many copies " * 20) for i in range(2000)], "doc_id bigint, text string")
    stored = packing.materialize(packing.tokenized(df.repartition(4)), "tokens")
    tasks = packing.dealt(stored, 5000, packing.END_TOKEN, packing.Tokens(None)).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 1000


def test_draws_leave_out_tokens_that_say_nothing():
    drawn = packing.draws(np.array([1, 10, 3, 0]), 10)
    assert np.isinf(drawn[:, [0, 1, 3]]).all() and np.isfinite(drawn[:, 2]).all() and len(set(drawn[:, 2])) == packing.DEAL


def test_words_are_learned_once_whatever_stands_beside_them():
    tokens = packing.Tokens(None)
    tokens.encode(["café. Éa, (café) caf12 21caf 'Zoë' ÉA".encode(), "café.Éa <|x.y|> 2,1".encode(), b""])
    assert sorted(w.decode() for w in tokens.words) == sorted("café . Éa , ( ) caf 1 2 'zoë' <|x.y|>".split())
    assert tokens.encode([]) == [] and tokens.encode([b"", b" \t"]) == [b"", b""]


def test_runs_of_letters_need_only_the_model(model, monkeypatch):
    tokens = packing.Tokens(None)
    monkeypatch.setattr(tokens, "_learn", lambda words: pytest.fail(f"tokenized with all rules: {words}"))
    text = "Über naïve Straße ǅ façade ÀÿŸ"
    ids = np.frombuffer(tokens.encode([text.encode()])[0], "<u2").tolist()
    assert ids == model.encode(text, add_special_tokens=False).ids


def test_letters_beside_all_classes_equal_whole_texts(model):
    beside = [".", "'", "'s", "1", "a", "x9", "<", "…", "é", "\u0301", "\u0338", "\u0307", "½", "ª"]
    texts = [f"{b}{c} {c}{b}{c} {c}{c}{b}" for c in [*packing.LATIN, "\u0130", "×", "÷", "ª", "\u0250", "=", "q"] for b in beside]
    found = packing.Tokens(None).encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u2").tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_other_rules_of_a_tokenizer(model, tmp_path):
    rules = model.to_str().replace("|[\\\\p{N}]|", "|[\\\\p{N}]+|")
    assert rules != model.to_str()
    (tmp_path / "other.json").write_text(rules)
    other = Tokenizer.from_file(str(tmp_path / "other.json"))
    tokens = packing.Tokens(str(tmp_path / "other.json"))
    text = "In 2024, (1234567) cafés sold 12x34.5 cups"
    ids = np.frombuffer(tokens.encode([text.encode()])[0], "<u2").tolist()
    assert ids == other.encode(text, add_special_tokens=False).ids != model.encode(text, add_special_tokens=False).ids
