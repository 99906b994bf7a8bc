"""Delimited text lines to a fingerprint table. Map-only: no row moves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmeans.functions.fingerprint import TOTAL_KINDS, hashed_fingerprint
from nestmeans.functions.text import split_literal, strip
from nestmeans.functions.vectors import cast_vector
from nestmeans.options import FingerprintOptions
from nestmeans.schemas import require_columns


def parse_lines(df: DataFrame, options: FingerprintOptions = FingerprintOptions()) -> DataFrame:
    """Add ``smiles`` and ``name``; both NULL when the line is rejected.

    The stripped line is split on the literal delimiter. Both fields must exist and not be
    empty; more fields are ignored, and a doubled delimiter makes an empty field.
    """
    return df.withColumn("_pair", _pair(df, options)).select(
        *df.columns, F.col("_pair.smiles").alias("smiles"), F.col("_pair.name").alias("name")
    )


def _pair(df: DataFrame, options: FingerprintOptions) -> Column:
    """(smiles, name) of a line, NULL when it is rejected; splits the line once."""
    require_columns(df, "value")
    needed = max(options.smiles_index, options.name_index) + 2
    accepted = F.filter(
        F.transform(
            F.array(split_literal(strip("value"), options.delimiter, needed)),
            lambda parts: F.struct(
                F.get(parts, options.smiles_index).alias("smiles"),
                F.get(parts, options.name_index).alias("name"),
            ),
        ),
        lambda pair: (F.length(pair["smiles"]) > 0) & (F.length(pair["name"]) > 0),
    )
    return F.get(accepted, 0)


def accepted_lines(df: DataFrame, options: FingerprintOptions = FingerprintOptions()) -> DataFrame:
    """The lines that parse, with their ``smiles`` and ``name`` instead of ``value``.

    A generator drops the rejected lines: a filter on the parsed fields would be pushed below the
    projection and parse every line twice.
    """
    pair = F.filter(F.array(_pair(df, options)), lambda p: p.isNotNull())
    return df.select(*[c for c in df.columns if c != "value"], F.inline(pair))


def add_fingerprint(
    df: DataFrame,
    col: str,
    options: FingerprintOptions = FingerprintOptions(),
    valid: Callable[[Column], Column] | None = None,
    out: str = "fp",
) -> DataFrame:
    require_columns(df, col)
    bits = hashed_fingerprint(
        col, options.fp_type, options.n_bits, options.radius, options.use_features, valid
    )
    return df.withColumn(out, cast_vector(bits, options.fp_dtype))


def fingerprint_lines(
    df: DataFrame,
    options: FingerprintOptions = FingerprintOptions(),
    valid: Callable[[Column], Column] | None = None,
    source: str | None = None,
) -> DataFrame:
    """(row_id, smiles, name, fp) of the lines that parse and have a fingerprint.

    ``source`` names a column to keep beside them, such as the file a line comes from.

    Short and empty lines are dropped before the fingerprint is computed.
    """
    parsed = accepted_lines(df, options)
    if valid is not None:
        parsed = parsed.filter(valid(F.col("smiles")))
    bits = add_fingerprint(parsed, "smiles", options)
    if options.fp_type.lower() not in TOTAL_KINDS:
        bits = bits.filter(F.col("fp").isNotNull())
    return bits.select("row_id", "smiles", "name", "fp", *([source] if source else []))


def fingerprint_report(
    df: DataFrame,
    options: FingerprintOptions = FingerprintOptions(),
    valid: Callable[[Column], Column] | None = None,
    source: str = "source_file",
) -> DataFrame:
    """Lines read, accepted and failed of every source, and their totals as source ``*``."""
    good = F.col("smiles").isNotNull()
    if valid is not None:
        good = good & F.coalesce(valid(F.col("smiles")), F.lit(False))
    per_source = parse_lines(df, options).groupBy(source).agg(
        F.count(F.lit(1)).alias("lines_read"), F.count_if(good).alias("succeeded")
    )
    return (
        per_source.rollup(source)
        .agg(
            F.sum("lines_read").alias("lines_read"),
            F.sum("succeeded").alias("succeeded"),
            F.grouping(source).alias("_all"),
        )
        .select(
            F.when(F.col("_all") == 1, "*").otherwise(F.col(source)).alias(source),
            "lines_read",
            "succeeded",
            (F.col("lines_read") - F.col("succeeded")).alias("failed"),
        )
    )
