"""Writing tables. Every sink is a distributed write with Spark's commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmeans.functions.vectors import cast_vector
from nestmeans.operators.ordinals import split_parts
from nestmeans.schemas import require_columns

# lzf stands for a fast codec, which is snappy in Parquet.
CODECS = {"gzip": "gzip", "lzf": "snappy", "zstd": "zstd", "snappy": "snappy",
          "none": "uncompressed", None: "uncompressed"}
DETAIL_COLUMNS = ["SMILES", "NAME", "CLUSTER_k2", "DISTANCE_k2"]


def _codec(name: str | None) -> str:
    if name not in CODECS:
        raise ValueError(f"compression must be one of {list(CODECS)}")
    return CODECS[name]


def _parquet(df: DataFrame, codec: str | None, level: int | None = None):
    writer = df.write.option("compression", _codec(codec))
    if level is not None and codec == "gzip":
        writer = writer.option("zlib.compress.level", _gzip_level(level))
    elif level is not None and codec == "zstd":
        writer = writer.option("parquet.compression.codec.zstd.level", level)
    return writer


# Level names of Parquet's gzip codec.
_GZIP_LEVELS = {0: "NO_COMPRESSION", 1: "BEST_SPEED", 2: "TWO", 3: "THREE", 4: "FOUR",
                5: "FIVE", 6: "SIX", 7: "SEVEN", 8: "EIGHT", 9: "BEST_COMPRESSION"}


def _gzip_level(level: int) -> str:
    if level not in _GZIP_LEVELS:
        raise ValueError("the gzip level must be in 0..9")
    return _GZIP_LEVELS[level]


def write_preprocessed(
    df: DataFrame, path: str, smiles_col: str = "smiles", id_col: str = "id",
    delimiter: str = " ", source: str | None = None,
) -> None:
    """Text table with a header; one folder per source when ``source`` is given.

    A table without rows still gets a file with the header.
    """
    require_columns(df, smiles_col, id_col, *([source] if source else []))
    columns = [smiles_col, id_col]
    out = df.select(*columns)
    if source and not df.isEmpty():
        partitioned(df.select(source, *columns), source).write.options(
            sep=delimiter, header=True, escape='"'
        ).partitionBy(source).csv(path)
    else:
        out.write.options(sep=delimiter, header=True, escape='"').csv(path)


def partitioned(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows with equal keys together for a partitioned write.

    A rebalance: adaptive execution splits large keys over several tasks and files, and packs
    small keys together, so one hot key does not end in one task.
    """
    return df.hint("rebalance", *keys)


def write_fingerprints(
    df: DataFrame, path: str, fp_dtype: str = "int8", compression: str | None = "gzip",
    level: int | None = 4, source: str | None = None,
) -> None:
    """Fingerprint table; one folder per source when ``source`` is given."""
    require_columns(df, "fp", *([source] if source else []))
    out = df.withColumn("fp", cast_vector("fp", fp_dtype))
    if source:
        _parquet(partitioned(out, source), compression, level).partitionBy(source).parquet(path)
    else:
        _parquet(out, compression, level).parquet(path)


def write_clusters(
    df: DataFrame, path: str, cluster: str = "cluster_k1", compression: str | None = "gzip",
    level: int | None = 4,
) -> None:
    """One folder per non-empty cluster: stage-1 rows, details or centers."""
    require_columns(df, cluster)
    if df.isEmpty():  # one file without rows keeps the schema for readers
        _parquet(df, compression, level).parquet(path)
        return
    _parquet(partitioned(df, cluster), compression, level).partitionBy(cluster).parquet(path)


def write_representatives(
    centers: DataFrame, path: str, compression: str | None = "gzip", level: int | None = 4
) -> None:
    """Final table: all representatives without the cluster columns."""
    out = centers.drop("cluster_k1", "CLUSTER_k2", "DISTANCE_k2")
    _parquet(out, compression, level).parquet(path)


def smi_lines(
    df: DataFrame, smiles: str = "smiles", name: str = "name", delimiter: str = " "
) -> DataFrame:
    """One text line per row: string, delimiter, name."""
    require_columns(df, smiles, name)
    return df.select(F.concat(F.col(smiles), F.lit(delimiter), F.col(name)).alias("value"))


def export_smi(
    df: DataFrame, path: str, smiles: str = "smiles", name: str = "name",
    delimiter: str = " ", write_header: bool = False,
) -> None:
    """Lines as they are, without quoting; with ``write_header`` every file starts with the two
    column names."""
    lines = smi_lines(df, smiles, name, delimiter).dropna()
    if not write_header:
        lines.write.text(path)
        return
    # One unquoted field per line, so the column name becomes the header line.
    titled = lines.withColumnRenamed("value", f"{smiles}{delimiter}{name}")
    titled.write.options(
        header=True, sep="\u0001", quote="", escape="", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def export_csv(
    df: DataFrame, path: str, columns: list[str] | None = None, cluster: str | None = None
) -> None:
    """CSV with a header and doubled quotes; one folder per cluster when ``cluster`` is given."""
    columns = columns or DETAIL_COLUMNS
    require_columns(df, *columns, *([cluster] if cluster else []))
    out = df.select(*columns, *([cluster] if cluster and cluster not in columns else []))
    if cluster:
        out = partitioned(out, cluster)
    writer = out.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    (writer.partitionBy(cluster) if cluster else writer).csv(path)


def recompress(
    spark: SparkSession, path_in: str, path_out: str, compression: str = "gzip",
    level: int | None = 9,
) -> None:
    """Rewrite a Parquet table with another codec; the rows stay the same."""
    _parquet(spark.read.parquet(path_in), compression, level).parquet(path_out)


def write_parts(df: DataFrame, path: str, n: int, order: list[str]) -> None:
    """Ordered parts 1..n, one folder each."""
    partitioned(split_parts(df, n, order), "part").write.partitionBy("part").parquet(path)
