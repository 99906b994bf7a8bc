"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
from nestmeans.llm import packing
from nestmeans.scratch import materialize
from test_decontaminate import brute as leaked
from test_jaccard import brute as classes
from test_packing import verify
from test_pii import expected

DATA = "/root/testdata/sf0.01"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    inputs, outputs = [], []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(rows_of(docs) if "doc_id" in docs.columns else None)
        docs = materialize(stage(spark, docs, DATA), name)
        outputs.append(docs)
        if name != "packing":
            assert docs.columns == columns
    kept = [rows_of(x) for x in outputs[:4]]
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    gone = set(inputs[0]) - set(kept[0])
    assert sum(truth.get(k) == 1 for k in gone) <= 0.02 * sum(v == 1 for v in truth.values())
    assert sum(truth.get(k) == 0 for k in kept[0]) <= 0.1 * sum(v == 0 for v in truth.values())
    found = classes([(k, r["text"]) for k, r in inputs[1].items()])
    assert set(kept[1]) == {k for k, (_, c) in found.items() if k == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(kept[2]) == set(inputs[2]) - {d for d, _ in leaked([(k, r["text"]) for k, r in inputs[2].items()], items)}
    assert set(kept[3]) == set(inputs[3])
    for k, r in kept[3].items():
        spans, before = expected(inputs[3][k]["text"]), inputs[3][k]["text"]
        assert all(before[a:b] not in r["text"] for _, a, b in spans)
        assert r["text"] == before or spans or "[IBAN]" in r["text"] or "[SSN]" in r["text"]
        assert r["n_chars"] == (len(r["text"]) if r["text"] != before else inputs[3][k]["n_chars"])
    model = Tokenizer.from_file(packing.tokenizer_path())
    verify(outputs[4].collect(), {k: r["text"] for k, r in kept[3].items()}, model)


def test_edge_documents(spark):
    rows = [
        (1, None, None, "s", 0), (2, "", "en", None, 0), (None, "no id here at all", "en", "s", 17), (3, "x " * 30000, "en", "s", 60000),
        (4, "This one is a fine sentence about rivers.", "en", "s", None), (4, "This one is a fine sentence about rivers.", "en", "s", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.no_benchmark, corpus_pipeline.no_personal_data):
        assert sorted(map(str, stage(spark, docs, DATA).collect())) == sorted(map(str, docs.collect()))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0
