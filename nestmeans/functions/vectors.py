"""Vector expressions over ARRAY columns, and the row order used for sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nestmeans.functions.text import as_column
from nestmeans.options import VECTOR_TYPES

HASH_BITS = 60


def hash_order(row_id: Column | str, seed: int) -> Column:
    """60-bit BIGINT, uniform over rows, fixed by the row id and the seed alone."""
    digest = F.md5(F.concat_ws(":", as_column(row_id).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def to_grid(vec: Column | str, scale: int) -> Column:
    """Coordinates as integers on the grid of width 1/scale."""
    return F.transform(
        as_column(vec),
        lambda x: F.floor(x.cast("double") * F.lit(float(scale)) + F.lit(0.5)).cast("int"),
    )


def squared_l2(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two arrays of one width."""
    return F.aggregate(
        F.zip_with(
            as_column(a), as_column(b),
            lambda x, y: (x.cast("double") - y.cast("double"))
            * (x.cast("double") - y.cast("double")),
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def popcount(bits: Column | str) -> Column:
    return F.aggregate(as_column(bits), F.lit(0), lambda total, b: total + b.cast("int"))


def is_binary(bits: Column | str) -> Column:
    return F.forall(as_column(bits), lambda b: b.isin(0, 1))


def on_bits(bits: Column | str) -> Column:
    """Sorted positions of the ones."""
    bits = as_column(bits)
    return F.filter(
        F.transform(bits, lambda b, i: F.when(b == 1, i)), lambda i: i.isNotNull()
    )


def to_dense(positions: Column | str, n_bits: int) -> Column:
    """0/1 vector of ``n_bits`` elements with ones at ``positions``."""
    every = F.sequence(F.lit(0), F.lit(n_bits - 1))
    # Binding the positions as a lambda argument keeps them from being computed once per bit.
    dense = F.transform(
        F.array(as_column(positions)),
        lambda found: F.transform(
            every, lambda i: F.array_contains(found, i).cast("tinyint")
        ),
    )
    return F.get(dense, 0)


def cast_vector(vec: Column | str, dtype: str) -> Column:
    """Storage type of the elements: int8, int16, int32 or int64."""
    if dtype not in VECTOR_TYPES:
        raise ValueError(f"dtype must be one of {sorted(VECTOR_TYPES)}")
    return as_column(vec).cast(f"array<{VECTOR_TYPES[dtype]}>")
