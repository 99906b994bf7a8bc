"""Files, sinks, unions, ordinals, profile, streaming and scratch handling."""

import os

import pytest
from pyspark.sql import functions as F

from nestmeans.operators.fingerprints import add_fingerprint
from nestmeans.operators.kmeans import kmeans_assign
from nestmeans.operators.normalize import canonical_dedup
from nestmeans.operators.ordinals import split_parts, with_ordinal
from nestmeans.operators.profile import missing_parts, preview, profile
from nestmeans.operators.union import compatible_rows, pick_columns, union_tables, vector_widths
from nestmeans.schemas import FINGERPRINTS, assert_schema, vector_contract
from nestmeans.sources import files, sinks
from nestmeans.streaming.incremental import stream_fingerprints, stream_lines, write_new


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode())


@pytest.fixture
def molecule_files(tmp_path):
    put(tmp_path / "a" / "x.smi", "smiles zinc_id mw\nCCO Z1 1\nF/C=C\\F Z2 2\n\"\"C Z3 3\n")
    put(tmp_path / "b" / "x.smi", "smiles zinc_id mw\nCCO Z4 4\nCCO Z5 5\n")
    put(tmp_path / "b" / "x_taut.smi", "smiles zinc_id mw\nN Z6 6\n")
    put(tmp_path / "b" / "notes.txt", "nothing\n")
    return str(tmp_path)


def test_find_files(spark, molecule_files):
    found = files.find_files(spark, molecule_files)
    assert sorted(r.path[-7:] for r in found.collect()) == ["a/x.smi", "b/x.smi"]
    assert files.find_files(spark, molecule_files, "*_taut.smi", None).count() == 1
    assert files.find_files(spark, molecule_files + "/none").count() == 0


def test_scan_delimited(spark, molecule_files):
    rows = files.scan_delimited(spark, molecule_files)
    assert rows.columns[:3] == ["smiles", "zinc_id", "mw"]
    assert {r.zinc_id: r.smiles for r in rows.collect()}["Z2"] == "F/C=C\\F"
    kept = canonical_dedup(rows, "smiles", "zinc_id", "identity", ["block_start", "row_id"])
    assert {r.zinc_id for r in kept.collect()} == {"Z1", "Z2", "Z3", "Z4"}
    with pytest.raises(ValueError, match="missing columns"):
        files.scan_delimited(spark, molecule_files, id_col="other")


def test_scan_lines(spark, tmp_path):
    put(tmp_path / "1.smi", "head one\n\"quoted\" a\n  spaced b \n\nlast c")
    put(tmp_path / "2.smi", "other header\nCC d\n")
    skipped = files.scan_lines(spark, str(tmp_path), True)
    assert {r.value for r in skipped.collect()} == {'"quoted" a', "  spaced b ", "", "last c", "CC d"}
    whole = files.scan_lines(spark, str(tmp_path), False)
    assert whole.count() == 7 and whole.filter("value = ''").count() == 1
    ordered = [r.value for r in whole.filter("source_file like '%1.smi'")
               .orderBy("block_start", "row_id").collect()]
    assert ordered[0] == "head one" and ordered[-1] == "last c"


def test_line_order_over_blocks(spark, tmp_path):
    """A file read in many blocks keeps its line order by (block_start, row_id)."""
    put(tmp_path / "1.smi", "".join(f"line{i} x\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = files.scan_lines(spark, str(tmp_path), False).orderBy("block_start", "row_id")
        got = [r.value for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [f"line{i} x" for i in range(5000)]


@pytest.fixture
def bits(spark):
    rows = [(i, f"C{'C' * (i % 7)}O", f"n{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, smiles string, name string")
    return add_fingerprint(df, "smiles")


@pytest.mark.parametrize("codec, level", [("gzip", 4), ("lzf", 4), ("none", None), ("zstd", 9)])
def test_fingerprint_table_roundtrip(spark, bits, tmp_path, codec, level):
    path = str(tmp_path / "fp")
    sinks.write_fingerprints(bits, path, compression=codec, level=level)
    back = files.read_fingerprints(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, bits.collect()))


def test_schema_check(spark, bits):
    assert_schema(bits, FINGERPRINTS)
    with pytest.raises(ValueError, match="missing"):
        assert_schema(bits.drop("fp"), FINGERPRINTS)
    with pytest.raises(ValueError, match="row_id"):
        assert_schema(bits.withColumn("row_id", F.lit("x")), FINGERPRINTS)
    r = vector_contract(bits.select(F.when(F.col("row_id") > 0, F.col("fp")).alias("fp")), "fp").first()
    assert (r.rows, r.max_width, r.bad_rows) == (60, 256, 1)


def test_empty_sinks_keep_the_header(spark, bits, tmp_path):
    none = bits.filter("row_id < 0")
    sinks.write_preprocessed(none, str(tmp_path / "t"), "smiles", "name")
    back = spark.read.options(header=True, sep=" ").csv(str(tmp_path / "t"))
    assert back.columns == ["smiles", "name"] and back.count() == 0
    sinks.write_fingerprints(none, str(tmp_path / "f"))
    assert files.read_fingerprints(spark, str(tmp_path / "f")).count() == 0
    sinks.export_csv(none, str(tmp_path / "c"), ["smiles", "row_id"])
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["smiles", "row_id"]


def test_partitioned_write_makes_few_files(spark, bits, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_clusters(bits.withColumn("cluster_k1", F.col("row_id").cast("int") % 5), path)
    folders = [d for d in os.listdir(path) if d.startswith("cluster_k1=")]
    assert len(folders) == 5
    assert all(len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]) == 1
               for d in folders)
    one = files.read_clusters(spark, path, 3)
    assert one.count() == 12
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cluster_k1" in plan


def test_exports(spark, bits, tmp_path):
    sinks.export_smi(bits, str(tmp_path / "s"), delimiter="\t")
    assert spark.read.text(str(tmp_path / "s")).filter("value like 'CO\tn%'").count() == 9
    odd = spark.createDataFrame([('say "hi", you', "x\ny")], "a string, b string").coalesce(1)
    sinks.export_csv(odd, str(tmp_path / "c"), ["a", "b"])
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("part-*"))
    assert text == 'a,b\n"say ""hi"", you","x\ny"\n'
    with pytest.raises(ValueError, match="missing columns"):
        sinks.export_csv(odd, str(tmp_path / "d"), ["a", "zz"])
    with pytest.raises(ValueError, match="compression"):
        sinks.write_fingerprints(bits, str(tmp_path / "e"), compression="rar")


def test_smi_header(spark, bits, tmp_path):
    sinks.export_smi(bits.coalesce(1), str(tmp_path / "s"), write_header=True)
    text = next((tmp_path / "s").glob("part-*")).read_text().splitlines()
    assert text[0] == "smiles name" and len(text) == 61 and text[1] == "CO n0"


def test_recompress(spark, bits, tmp_path):
    sinks.write_fingerprints(bits, str(tmp_path / "a"), compression="none", level=None)
    sinks.recompress(spark, str(tmp_path / "a"), str(tmp_path / "b"), "zstd", 9)
    back = files.read_fingerprints(spark, str(tmp_path / "b"))
    assert sorted(map(str, back.collect())) == sorted(map(str, bits.collect()))
    assert any(".zstd" in name for name in os.listdir(tmp_path / "b"))


def test_union_rejects_whole_sources(spark):
    a = spark.createDataFrame([(1, [0, 1])], "k int, fp array<tinyint>")
    b = spark.createDataFrame([(2, [0, 1, 1])], "k int, fp array<tinyint>")
    c = spark.createDataFrame([(3, [1, 1]), (4, [1])], "k int, fp array<tinyint>")
    d = spark.createDataFrame([(5, [1, 1]), (6, [1, 0])], "k int, fp array<tinyint>")
    rows = union_tables({"a": a, "b": b, "c": c, "d": d}, source="s")
    assert rows.count() == 6
    assert {(r.s, r.accepted) for r in vector_widths(rows, "s").collect()} == {
        ("a", True), ("b", False), ("c", False), ("d", True)}
    assert {r.k for r in compatible_rows(rows, "s", on_mismatch="drop").collect()} == {1, 5, 6}
    with pytest.raises(ValueError, match="another width"):
        compatible_rows(rows, "s")
    odd = union_tables({"a": b, "b": a.union(a).union(a)}, source="s")  # most rows decide
    assert {r.k for r in compatible_rows(odd, "s", on_mismatch="drop").collect()} == {1}
    assert {r.k for r in compatible_rows(odd, "s", wanted=3, on_mismatch="drop").collect()} == {2}


def test_union_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2, 0)], "s string, k int, more int")
    assert {tuple(r) for r in union_tables({"a": a, "b": b}).collect()} == {(1, "x"), (2, "y")}
    assert pick_columns(a, ["s", "zz"]).columns == ["s"]
    with pytest.raises(ValueError):
        pick_columns(a, ["zz"])
    with pytest.raises(ValueError):
        union_tables({"b": b, "a": a})


@pytest.mark.parametrize("n, rows", [(1, 10), (3, 10), (10, 10), (20, 10), (4, 0), (7, 100)])
def test_split_parts(spark, n, rows):
    df = spark.range(rows).select((F.col("id") * 3 % 1009).alias("key")).repartition(5)
    got = sorted((r.key, r.part) for r in split_parts(df, n, ["key"]).collect())
    size = max(1, -(-rows // n))
    assert [p for _, p in got] == [min(i // size, n - 1) + 1 for i in range(rows)]


def test_ordinal_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("key")).repartition(13)
    got = {r.key: r.rn for r in with_ordinal(df, ["key"]).collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_profile_and_preview(spark):
    df = spark.createDataFrame(
        [(1, "b", [1, 2]), (2, None, [3]), (3, "a", None)], "k int, s string, v array<int>"
    )
    got = {r.column: tuple(r)[1:] for r in profile(df).collect()}
    assert got == {
        "k": ("int", 3, 0, "1", "3"), "s": ("string", 3, 1, "a", "b"),
        "v": ("array<int>", 3, 1, "1", "2"),
    }
    assert [r.s for r in preview(df, "s", "k", 2).collect()] == ["b", None]
    with pytest.raises(ValueError):
        preview(df, "zz", "k")
    present = df.select("k").filter("k < 3")
    assert [r.k for r in missing_parts(df, present, "k").collect()] == [3]


def test_stream_reads_new_files_only(spark, tmp_path):
    put(tmp_path / "in" / "1.smi", "CCO a\nbad\n")
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        bits = stream_fingerprints(stream_lines(spark, str(tmp_path / "in")))
        query = write_new(bits, out, progress)
        query.awaitTermination(120)
        return {r.name for r in spark.read.parquet(out).collect()}

    assert run() == {"a"}
    put(tmp_path / "in" / "2.smi", "CCC b\n")
    assert run() == {"a", "b"}
    assert spark.read.parquet(out).count() == 2


def test_assign_on_a_stream(spark, tmp_path):
    """Assignment against stored centroids needs no state, so it runs on a stream as it is."""
    path = str(tmp_path / "rows")
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, 9.0])], "row_id bigint, fp array<double>")
    rows.write.parquet(path)
    model = spark.createDataFrame([(0, [8.0, 8.0]), (1, [1.0, 0.0])], "cluster int, centroid array<double>")
    stream = spark.readStream.schema(rows.schema).parquet(path)
    out = str(tmp_path / "out")
    query = write_new(kmeans_assign(stream, model), out, str(tmp_path / "progress"))
    query.awaitTermination(120)
    got = {r.row_id: (r.cluster, r.dist) for r in spark.read.parquet(out).collect()}
    assert got == {1: (1, 1.0), 2: (0, 2.0)}


def test_document_representatives_store_no_text(spark, tmp_path, monkeypatch):
    """Tables on the way hold ids and bits: texts of 4 MB leave less than a tenth of that on disk."""
    import random

    from nestmeans import scratch
    from nestmeans.catalog.queries import QUERIES

    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000)) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.write.parquet(str(tmp_path / "in" / "documents.parquet"))
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path / "scratch"))
    found = QUERIES["document_representatives"](spark, str(tmp_path / "in"))
    assert found.count() == found.select("row_id").distinct().count() > 0
    stored = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "scratch") for f in names]
    assert stored and sum(map(os.path.getsize, stored)) < sum(map(len, texts)) / 10
