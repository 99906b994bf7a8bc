"""Look into a table: column profile, first values, missing parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmeans.schemas import require_columns


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, smallest and largest value as text.

    Arrays show their width instead of their values. One pass over the table.
    """
    facts = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema):
        c = F.col(f"`{field.name}`")
        shown = F.size(c) if isinstance(field.dataType, T.ArrayType) else c
        shown = F.when(c.isNotNull(), shown)
        facts += [
            F.count(c).alias(f"n{i}"),
            F.min(shown).cast("string").alias(f"lo{i}"),
            F.max(shown).cast("string").alias(f"hi{i}"),
        ]
    lines = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, field in enumerate(df.schema)
    ]
    return df.agg(*facts).select(F.inline(F.array(*lines)))


def preview(df: DataFrame, column: str, order: str | list[str], n: int = 10) -> DataFrame:
    """The first n values of one column by ``order``."""
    order = [order] if isinstance(order, str) else order
    require_columns(df, column, *order)
    names = dict.fromkeys([*order, column])
    return df.select(*names).orderBy(*order).limit(n)


def missing_parts(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Expected keys that are not present."""
    return expected.select(key).distinct().join(present.select(key), key, "left_anti")
