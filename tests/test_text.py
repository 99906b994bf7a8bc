"""Line parsing, normalisation, deduplication and fingerprints on small tables."""

import pytest
from pyspark.sql import functions as F

from nestmeans.functions import fingerprint as fpm
from nestmeans.functions import text
from nestmeans.functions.rules import k2_expr
from nestmeans.functions.vectors import is_binary, on_bits, popcount, to_dense
from nestmeans.operators.fingerprints import (
    add_fingerprint, fingerprint_lines, fingerprint_report, parse_lines,
)
from nestmeans.operators.normalize import canonical_dedup, normalize, preprocess_report
from nestmeans.options import FingerprintOptions

# A few well-known molecules; the last line is not one.
MOLECULES = [
    "CCO ethanol", "C1=CC=CC=C1 benzene", "CC(C)=O acetone", "C=C(O)C propen-2-ol",
    "C[C@H](N)O chiral", "Clc1ccccc1 chlorobenzene", "NotASmiles broken",
]


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(
    "value", ["  a b ", "\t\r\n x ", " y　", "", " ", "\x1cz\x85", "a​b"]
)
def test_strip_is_python_strip(spark, value):
    assert one(spark, text.strip(F.lit(value))) == value.strip()


@pytest.mark.parametrize(
    "value", [" A  b\t\tC ", "x\n\ny", "  a  　b", "", " \t", "a \tb", "a\t b", "a b"]
)
def test_fold(spark, value):
    assert one(spark, text.fold(F.lit(value))) == (" ".join(value.split()).lower() or None)


@pytest.mark.parametrize(
    "value, want",
    [("CC.CCC.CCO", "CCC"), ("A.B", "A"), ("..", None), ("", None), (" abc ", "abc"), (None, None)],
)
def test_largest_fragment(spark, value, want):
    assert one(spark, text.largest_fragment(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize(
    "value, want",
    [("CCO", True), ("invalid", False), ("invalid-smiles", False), ("NotASmiles", False),
     ("", False), ("F/C=C\\F", True), ("[Na+].[Cl-]", True), ("C%12CC%12", True)],
)
def test_smiles_like(spark, value, want):
    assert one(spark, text.smiles_like(F.lit(value))) is want


def lines(spark, values):
    rows = [(i, "f", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "row_id bigint, source_file string, value string")


def test_parse_lines(spark):
    values = ["CCO a", "CCO", "CCO  a", "CCO a\r", "\tCCO a\t", "CCO a extra", "", " x", None]
    got = parse_lines(lines(spark, values)).orderBy("row_id").collect()
    kept = {r.row_id: (r.smiles, r.name) for r in got if r.smiles}
    assert kept == {0: ("CCO", "a"), 3: ("CCO", "a"), 4: ("CCO", "a"), 5: ("CCO", "a")}
    assert len(got) == 9


@pytest.mark.parametrize("delimiter", ["|", "\t", ".", "\\E", "::"])
def test_literal_delimiter(spark, delimiter):
    options = FingerprintOptions(delimiter=delimiter, smiles_index=2, name_index=0)
    got = parse_lines(lines(spark, [delimiter.join(["n", "x", "CC"])]), options).first()
    assert (got.smiles, got.name) == ("CC", "n")


def test_fingerprint_lines_and_report(spark):
    df = lines(spark, MOLECULES + ["short", "C  x"])
    got = fingerprint_lines(df, valid=text.smiles_like)
    assert {r.name for r in got.collect()} == {m.split()[1] for m in MOLECULES[:-1]}
    assert got.filter(is_binary("fp") & (F.size("fp") == 256) & (popcount("fp") > 0)).count() == 6
    report = {r.source_file: tuple(r)[1:] for r in
              fingerprint_report(df, valid=text.smiles_like).collect()}
    assert report == {"f": (9, 6, 3), "*": (9, 6, 3)}


def test_fingerprint_contract(spark):
    """Valid, invalid and empty input."""
    rows = spark.createDataFrame([("CCO",), ("invalid-smiles",), ("",), (None,)], "s string")
    got = rows.select("s", fpm.hashed_fingerprint("s", valid=text.smiles_like).alias("fp")).collect()
    assert len(got[0].fp) == 256 and set(got[0].fp) == {0, 1}
    assert [r.fp for r in got[1:]] == [None, None, None]


def test_fingerprint_kinds(spark):
    rows = spark.createDataFrame([("a b a",)], "s string")
    assert rows.select(popcount(fpm.hashed_fingerprint("s", "token")).alias("n")).first().n == 2
    with pytest.raises(ValueError, match="unknown"):
        fpm.hashed_fingerprint("s", "morgan")
    fpm.register_fingerprint("length", lambda c, n, r: to_dense(F.array(F.length(c) % n), n))
    assert rows.select(on_bits(fpm.hashed_fingerprint("s", "length", 8)).alias("b")).first().b == [5]
    with pytest.raises(ValueError, match="built in"):
        fpm.register_fingerprint("qgram", lambda c, n, r: c)


def test_feature_classes_join_similar_symbols(spark):
    rows = spark.createDataFrame([("CCCl",), ("CCBr",), ("CCF",)], "s string")
    bits = rows.select(fpm.hashed_fingerprint("s", use_features=True).alias("fp"))
    assert bits.distinct().count() == 1


@pytest.mark.parametrize("dtype, kind", [("int8", "tinyint"), ("int64", "bigint")])
def test_fingerprint_storage_type(spark, dtype, kind):
    rows = spark.createDataFrame([("CCO",)], "s string")
    got = add_fingerprint(rows, "s", FingerprintOptions(fp_dtype=dtype))
    assert got.schema["fp"].dataType.elementType.simpleString() == kind


TABLE = [
    (1, "f1", "a1", "CC  O"), (2, "f1", "a2", "cc o"), (3, "f2", "a3", "CC O"), (4, "f2", "a4", None),
    (5, "f2", "a5", ""), (6, "f2", "a6", "  "), (7, "f1", "a7", "N"),
]


@pytest.fixture
def molecules(spark):
    return spark.createDataFrame(
        TABLE, "row_id bigint, source_file string, id string, smiles string"
    ).repartition(4)


def test_dedup_scopes(molecules):
    local = canonical_dedup(molecules).collect()
    assert {(r.source_file, r.smiles, r.id) for r in local} == {
        ("f1", "cc o", "a1"), ("f2", "cc o", "a3"), ("f1", "n", "a7")}
    whole = canonical_dedup(molecules, scope="global")
    assert whole.columns == ["smiles", "id"]
    assert {tuple(r) for r in whole.collect()} == {("cc o", "a1"), ("n", "a7")}


def test_dedup_by_several_order_columns(molecules):
    got = canonical_dedup(molecules, scope="global", order=["source_file", "row_id"])
    assert {r.id for r in got.collect()} == {"a1", "a7"}


def test_preprocess_report(molecules):
    got = {r[0]: tuple(r)[1:] for r in preprocess_report(molecules).collect()}
    assert got == {"f1": (3, 3, 0, 0, 1, 2), "f2": (4, 1, 2, 1, 0, 1)}


def test_normalize_with_user_rules(spark):
    @F.pandas_udf("string")
    def ketone(s):
        return s.replace({"C=C(O)C": "CC(C)=O"}).where(s != "invalid")

    rows = spark.createDataFrame([("C=C(O)C",), ("invalid",), ("CCO",), ("",)], "s string")
    got = [r.canonical for r in normalize(rows, "s", ketone).collect()]
    assert got == ["CC(C)=O", None, "CCO", None]
    with pytest.raises(ValueError, match="unknown rule"):
        normalize(rows, "s", "nope")


@pytest.mark.parametrize(
    "n, method, value, base_k, want",
    [(1, "ratio", 8.0, 2, 1), (2, "ratio", 8.0, 2, 2), (9, "ratio", 8.0, 2, 2),
     (17, "ratio", 8.0, 2, 3), (800, "ratio", 8.0, 2, 100), (800, "ratio", 0.1, 2, 800),
     (101, "sqrt", 8.0, 2, 11), (100, "sqrt", 8.0, 2, 10), (50, "fixed", 12.9, 2, 12),
     (5, "fixed", 12.0, 2, 5), (3, "fixed", 2.0, 7, 3), (17, "default", 99.0, 2, 3),
     (500_000, "ratio", 500.0, 1000, 1000)],
)
def test_k2_rule(spark, n, method, value, base_k, want):
    assert one(spark, k2_expr(F.lit(n), method, value, base_k)) == want


def test_k2_rule_rejects():
    with pytest.raises(ValueError):
        k2_expr(F.lit(1), "other")
    with pytest.raises(ValueError):
        k2_expr(F.lit(1), base_k=0)
