"""Reading file sets: discovery, text tables, lines and fingerprint tables."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmeans.operators.union import pick_columns, vector_widths
from nestmeans.schemas import FINGERPRINTS, assert_schema, require_columns
from nestmeans.scratch import settle

_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("length", T.LongType()),
])
_PLACE = ("source_file", "block_start", "row_id")


def _options(reader, pattern: str | None, recursive: bool = True):
    reader = reader.option("recursiveFileLookup", recursive)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _kept(exclude: str | None) -> Column:
    """True for files whose base name lacks the exclusion text; none excludes nothing."""
    if not exclude:
        return F.lit(True)
    return ~F.col("_metadata.file_name").contains(exclude)


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def find_files(
    spark: SparkSession, folder: str, pattern: str = "*.smi", exclude: str | None = "_taut"
) -> DataFrame:
    """Files below the folder as (path, file_name, length). A missing folder has none.

    Only listings are read, not the files.
    """
    try:
        files = _options(spark.read.format("binaryFile"), pattern).load(folder)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], _FILES)
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select("path", name.alias("file_name"), "length")
    return found.filter(~F.col("file_name").contains(exclude)) if exclude else found


def _placed(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Add where a row stands: file, start of its block, increasing number inside the block."""
    return df.select(*columns, *_place_columns())


def _place_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    ]


def _first_lines(lines: DataFrame) -> DataFrame:
    """(source_file, header): the first line of every file of a text read."""
    placed = _placed(lines, "value").filter("block_start = 0")
    return placed.groupBy("source_file").agg(F.min_by("value", "row_id").alias("header"))


def scan_delimited(
    spark: SparkSession,
    folder: str,
    smiles_col: str = "smiles",
    id_col: str = "zinc_id",
    delimiter: str = " ",
    pattern: str = "*.smi",
    exclude: str | None = "_taut",
    on_bad: str = "raise",
) -> DataFrame:
    """Text tables with a header, columns found by name and read as strings.

    Every file is read by its own header; the columns of all files are kept (NULL where a file
    lacks one), then source_file, block_start and row_id. Rows of one file are in order by
    (block_start, row_id). A file without ``smiles_col`` or ``id_col`` is an error, or is left
    out with ``on_bad="skip"``. Excluded files are not looked at.
    """
    _check_mode(on_bad)
    lines = _options(spark.read, pattern).text(folder).filter(_kept(exclude))
    groups: dict[tuple[str, ...], list[str]] = {}
    bad = []
    for row in _first_lines(lines).orderBy("source_file").collect():  # one row per file
        names = tuple(next(csv.reader([row.header or ""], delimiter=delimiter), ()))
        if {smiles_col, id_col} <= set(names) and len(set(names)) == len(names):
            groups.setdefault(names, []).append(_local_name(row.source_file))
        else:
            bad.append(f"{row.source_file}: {list(names)}")
    if bad and on_bad == "raise":
        raise ValueError(f"missing columns {smiles_col} or {id_col}: {bad[:5]}")
    parts = []
    for names, paths in groups.items():
        fields = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.schema(fields).options(sep=delimiter, header=True, escape='"')
        part = reader.csv([_no_glob(path) for path in paths])
        parts.append(part.select("*", *_place_columns()))
    if not parts:
        fields = [T.StructField(n, T.StringType()) for n in (smiles_col, id_col)]
        none = spark.createDataFrame([], T.StructType(fields))
        return none.select("*", F.lit("").alias("source_file"), F.lit(0).cast("bigint").alias("block_start"),
                           F.lit(0).cast("bigint").alias("row_id"))
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    names = [c for c in rows.columns if c not in _PLACE]
    return rows.select(*(F.col(f"`{c}`") for c in names), "source_file", "block_start",
                       F.monotonically_increasing_id().alias("row_id"))


def _check_mode(on_bad: str) -> None:
    if on_bad not in ("raise", "skip"):
        raise ValueError("on_bad must be 'raise' or 'skip'")


def _local_name(uri: str) -> str:
    """The path that a file URI of ``_metadata`` stands for."""
    return unquote(uri)


def _no_glob(path: str) -> str:
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def scan_lines(
    spark: SparkSession,
    folder: str,
    skip_header: bool = True,
    pattern: str = "*.smi",
    exclude: str | None = None,
) -> DataFrame:
    """Text lines as (value, source_file, block_start, row_id).

    ``skip_header`` drops the first line of every file, whatever it holds. Blank lines stay and
    can be counted as failures.
    """
    rows = _placed(_options(spark.read, pattern).text(folder).filter(_kept(exclude)), "value")
    return rows.mapInArrow(_without_first, rows.schema) if skip_header else rows


def _without_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the row that begins the first block of a file; blocks follow each other whole."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names, starts = batch["source_file"], batch["block_start"].to_numpy()
        fresh = np.ones(batch.num_rows, dtype=bool)
        same = pc.equal(names.slice(1), names.slice(0, batch.num_rows - 1))
        fresh[1:] = ~same.to_numpy(zero_copy_only=False) | (starts[1:] != starts[:-1])
        fresh[0] = last != (names[0].as_py(), starts[0])
        last = names[batch.num_rows - 1].as_py(), starts[-1]
        yield batch.filter(pa.array(~(fresh & (starts == 0))))


def read_fingerprints(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """A fingerprint table, checked for its columns. Many files are one table."""
    return assert_schema(_options(spark.read, pattern, recursive).parquet(path), FINGERPRINTS)


def _lacks(spark: SparkSession, path: str, names: list[str]) -> bool:
    """Whether a Parquet file's own schema, from its footer, lacks one of the columns."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, conf))
    try:
        held = {f.getName().lower() for f in reader.getFileMetaData().getSchema().getFields()}
    finally:
        reader.close()
    return any(n.lower() not in held for n in names)


def read_tables(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.parquet",
    recursive: bool = True,
    columns: list[str] | None = None,
    vec: str | None = "fp",
    on_bad: str = "raise",
) -> DataFrame:
    """Union of all matching Parquet files below a folder, plus source_file.

    No matching file is an error. Unknown names in ``columns`` are skipped. A file that lacks a
    column another one has, or whose vectors ``vec`` differ in width from those of most rows, is
    an error, or is left out as a whole with ``on_bad="skip"``. A column that a file has, with NULL in all its rows, is
    no reason: files without a value in some column are told apart by their footers.
    """
    _check_mode(on_bad)
    merged = _options(spark.read, pattern, recursive).option("mergeSchema", True).parquet(folder)
    df = pick_columns(merged, columns).select("*", F.col("_metadata.file_path").alias("source_file"))
    names = [c for c in df.columns if c != "source_file"]
    # A column that a file lacks is NULL in all its rows; the footers of such files tell whether it is there.
    filled = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]
    checks = df.groupBy("source_file").agg(*filled)
    some = checks.agg(*[F.max(f"n{i}").alias(f"m{i}") for i in range(len(names))]).first()
    lacking = reduce(
        lambda x, y: x | y,
        [(F.col(f"n{i}") == 0) & F.lit(bool(some[i])) for i in range(len(names))],
    )
    suspects = [r.source_file for r in checks.filter(lacking).select("source_file").toLocalIterator()]
    used = [c for i, c in enumerate(names) if some[i]]
    with ThreadPoolExecutor(16) as pool:
        lacks = list(pool.map(lambda path: _lacks(spark, path, used), suspects))
    bad = spark.createDataFrame([(path,) for path, gone in zip(suspects, lacks) if gone], "source_file string")
    if vec and vec in names:
        widths = vector_widths(df, "source_file", vec)
        bad = bad.unionByName(widths.filter(~F.col("accepted")).select("source_file")).distinct()
    bad = settle(bad, 100_000)
    first = [r.source_file for r in bad.limit(5).collect()]
    if not first:
        return df
    if on_bad == "raise":
        raise ValueError(f"files that do not fit the others: {first}")
    return df.join(bad, "source_file", "left_anti").select(*df.columns)


def read_clusters(spark: SparkSession, path: str, cluster: int | None = None) -> DataFrame:
    """A table partitioned by cluster_k1; one cluster reads only its own folder."""
    df = spark.read.parquet(path)
    require_columns(df, "cluster_k1")
    return df if cluster is None else df.filter(F.col("cluster_k1") == cluster)
