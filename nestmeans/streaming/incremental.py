"""The map-only steps on files as they arrive.

Each input file is handled on its own, as in the batch job, so a file stream needs no state:
the fingerprint of a line and the cluster of a row depend on that row and the stored model only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nestmeans.functions.fingerprint import hashed_fingerprint
from nestmeans.operators.fingerprints import accepted_lines
from nestmeans.options import FingerprintOptions


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*.smi") -> DataFrame:
    """New text lines below a folder with the file they come from."""
    lines = spark.readStream.option("pathGlobFilter", pattern).text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"))


def stream_fingerprints(
    lines: DataFrame, options: FingerprintOptions = FingerprintOptions()
) -> DataFrame:
    """(source_file, smiles, name, fp) of the lines that parse."""
    fp = hashed_fingerprint(
        "smiles", options.fp_type, options.n_bits, options.radius, options.use_features
    )
    return accepted_lines(lines, options).select(
        "source_file", "smiles", "name", fp.alias("fp")
    )


def write_new(df: DataFrame, path: str, progress: str) -> StreamingQuery:
    """Append everything that has arrived since the last run, then stop."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
