"""Union of tables that share columns and a vector width."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.schemas import require_columns
from nestmeans.scratch import settle

_LOCAL_ROWS = 100_000


def pick_columns(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """The wanted columns that exist, in the wanted order; None keeps all. None left is an error."""
    if columns is None:
        return df
    found = [c for c in columns if c in df.columns]
    if not found:
        raise ValueError(f"none of {columns} found; available: {df.columns}")
    return df.select(*found)


def union_tables(
    tables: dict[str, DataFrame], columns: list[str] | None = None, source: str | None = None
) -> DataFrame:
    """All rows of all tables. The first table decides the columns; a table without one of them
    is an error. ``source`` names a column that gets the key of the table."""
    if not tables:
        raise ValueError("no tables to union")
    first = pick_columns(next(iter(tables.values())), columns)
    parts = []
    for key, df in tables.items():
        part = require_columns(df, *first.columns).select(*first.columns)
        parts.append(part.withColumn(source, F.lit(key)) if source else part)
    return reduce(DataFrame.unionByName, parts)


def vector_widths(
    df: DataFrame, source: str, vec: str = "fp", wanted: int | None = None
) -> DataFrame:
    """Rows and vector widths of every source; ``accepted`` when all its vectors have the width
    ``wanted``, by default that of the sources with most rows. One pass over the table, run now."""
    width = F.size(vec)
    per_source = df.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(width).cast("bigint").alias("min_width"),
        F.max(width).cast("bigint").alias("max_width"),
    )
    per_source = settle(per_source, _LOCAL_ROWS)
    if wanted is None:
        even = per_source.filter("min_width = max_width AND min_width > 0").groupBy("min_width")
        votes = even.agg(F.sum("rows").alias("rows"))
        width = votes.agg(F.max_by("min_width", F.struct("rows", -F.col("min_width")))).scalar()
    else:
        width = F.lit(wanted)
    fits = (F.col("min_width") == width) & (F.col("max_width") == width)
    return per_source.withColumn("accepted", F.coalesce(fits, F.lit(False)))


def compatible_rows(
    df: DataFrame, source: str, vec: str = "fp", wanted: int | None = None,
    on_mismatch: str = "raise",
) -> DataFrame:
    """Rows of the accepted sources. A source with vectors of another width is an error that names
    it, or is left out as a whole with ``on_mismatch="drop"``."""
    if on_mismatch not in ("raise", "drop"):
        raise ValueError("on_mismatch must be 'raise' or 'drop'")
    widths = vector_widths(df, source, vec, wanted)
    if on_mismatch == "raise":
        bad = [r[0] for r in widths.filter("NOT accepted").select(source).limit(5).collect()]
        if bad:
            raise ValueError(f"vectors of another width in {bad}")
        return df
    return df.join(widths.filter("accepted").select(source), source, "left_semi")
