"""Sources that lose nothing, and sinks without rows."""

import pytest
from pyspark.sql import functions as F

from nestmeans.operators.fingerprints import fingerprint_report
from nestmeans.options import FingerprintOptions
from nestmeans.sources import files, sinks


def write(folder, name, text):
    (folder / name).write_bytes(text.encode())


def test_each_file_has_its_own_header(spark, tmp_path):
    write(tmp_path, "a.smi", "smiles zinc_id\nC 1\nCC 2\n")
    write(tmp_path, "b b.smi", "zinc_id extra smiles\n3 x CCC\n")
    write(tmp_path, "c_taut.smi", "something else\n" + "y z\n" * 500)
    rows = files.scan_delimited(spark, str(tmp_path)).collect()
    assert {(r.smiles, r.zinc_id, r.extra) for r in rows} == {("C", "1", None), ("CC", "2", None), ("CCC", "3", "x")}
    assert len({r.row_id for r in rows}) == 3
    write(tmp_path, "d.smi", "smiles name\nO 9\n")
    with pytest.raises(ValueError, match="d.smi"):
        files.scan_delimited(spark, str(tmp_path))
    assert files.scan_delimited(spark, str(tmp_path), on_bad="skip").count() == 3


def test_lines_keep_control_characters_and_blanks(spark, tmp_path):
    write(tmp_path, "a.smi", "head\nC\u0001C n1\n\n  \nC,\"C n2\n")
    write(tmp_path, "b.smi", "\nfirst line was blank\n")
    write(tmp_path, "c.smi", "only a header")
    lines = files.scan_lines(spark, str(tmp_path), True)
    assert sorted(r.value for r in lines.collect()) == ["", "  ", "C\u0001C n1", "C,\"C n2", "first line was blank"]
    report = fingerprint_report(lines, FingerprintOptions()).agg(F.max("lines_read")).first()[0]
    assert report == 5


def test_header_is_dropped_once_per_file_in_many_blocks(spark, tmp_path):
    text = "header\n" + "".join(f"line {i}\n" for i in range(5000))
    for name in ("a.smi", "b.smi"):
        write(tmp_path, name, text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = files.scan_lines(spark, str(tmp_path), True)
        assert lines.count() == 10_000 and lines.filter("value = 'header'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_that_do_not_fit(spark, tmp_path):
    good = spark.createDataFrame([("C", [0, 1]), ("O", [1, 1])], "smiles string, fp array<tinyint>")
    for i in range(2):
        good.coalesce(1).write.parquet(str(tmp_path / f"good{i}"))
    assert files.read_tables(spark, str(tmp_path)).count() == 4
    spark.createDataFrame([("N", [1, 1, 1])], good.schema).coalesce(1).write.parquet(str(tmp_path / "wide"))
    good.drop("smiles").coalesce(1).write.parquet(str(tmp_path / "narrow"))
    with pytest.raises(ValueError, match="do not fit"):
        files.read_tables(spark, str(tmp_path))
    rows = files.read_tables(spark, str(tmp_path), on_bad="skip")
    assert sorted(r.smiles for r in rows.collect()) == ["C", "C", "O", "O"]
    # a column that nobody asked for is not missed
    assert files.read_tables(spark, str(tmp_path), columns=["fp"], vec=None).count() == 7


def test_a_column_without_values_is_there(spark, tmp_path):
    """A file with NULL in all rows of a column stays; one that lacks the column does not. Odd names are read too."""
    kind = "smiles string, note string, fp array<tinyint>"
    whole = spark.createDataFrame([("C", "a", [0, 1]), ("O", None, [1, 1])], kind)
    whole.coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([("N", None, [0, 0]), ("S", None, [0, 1])], kind).coalesce(1).write.parquet(str(tmp_path / "a b%20c"))
    assert files.read_tables(spark, str(tmp_path)).count() == 4
    assert files.read_tables(spark, str(tmp_path), on_bad="skip").count() == 4
    whole.drop("note").coalesce(1).write.parquet(str(tmp_path / "lacks"))
    with pytest.raises(ValueError, match="lacks"):
        files.read_tables(spark, str(tmp_path))
    assert sorted(r.smiles for r in files.read_tables(spark, str(tmp_path), on_bad="skip").collect()) == ["C", "N", "O", "S"]


def test_empty_results_are_readable(spark, tmp_path):
    none = spark.createDataFrame([], "row_id bigint, smiles string, id string, src string, cluster_k1 int")
    sinks.write_clusters(none, str(tmp_path / "clusters"))
    back = files.read_clusters(spark, str(tmp_path / "clusters"))
    assert back.count() == 0 and "cluster_k1" in back.columns
    sinks.write_preprocessed(none, str(tmp_path / "pre"), source="src")
    heads = spark.read.text(str(tmp_path / "pre")).collect()
    assert [r.value for r in heads] == ["smiles id"]
