"""Table layouts passed between the steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "array<tinyint>": T.ArrayType(T.ByteType()),
    "array<double>": T.ArrayType(T.DoubleType()),
}


def _struct(text: str) -> T.StructType:
    fields = (part.split() for part in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


MOLECULES = _struct("smiles string, id string, source_file string, row_id bigint")
PREPROCESSED = _struct("smiles string, id string")
LINES = _struct("value string, source_file string, row_id bigint")
FINGERPRINTS = _struct("row_id bigint, smiles string, name string, fp array<tinyint>")
STAGE1 = _struct(
    "row_id bigint, smiles string, name string, fp array<tinyint>, cluster_k1 int, dist double"
)
CENTROIDS = _struct("cluster int, centroid array<double>, n bigint, objective double")
DETAILS = _struct(
    "row_id bigint, SMILES string, NAME string, cluster_k1 int, CLUSTER_k2 int, DISTANCE_k2 float"
)
CENTERS = _struct(
    "row_id bigint, smiles string, name string, fp array<tinyint>, "
    "cluster_k1 int, CLUSTER_k2 int, DISTANCE_k2 float"
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail at plan time unless ``df`` has the columns of ``schema`` with the same types.

    Vector columns may use any integer or floating element type.
    """
    require_columns(df, *schema.names)
    wrong = []
    for field in schema:
        got = df.schema[field.name].dataType
        vector = isinstance(got, T.ArrayType) and isinstance(field.dataType, T.ArrayType)
        same = isinstance(got.elementType, T.NumericType) if vector else got == field.dataType
        if not same:
            wrong.append(f"{field.name}: {got.simpleString()} is not {field.dataType.simpleString()}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def vector_width(df: DataFrame, vec: str) -> int | None:
    """Width of the vectors, read from one row; None for an empty table.

    The clustering kernels check every other row against it while they work.
    """
    row = df.select(F.size(vec).alias("d")).first()
    if row is not None and row.d < 1:
        raise ValueError(f"{vec} holds a NULL or empty vector")
    return None if row is None else row.d


def payload_bytes(df: DataFrame, skip: set[str]) -> Column:
    """Bytes of a row's values of variable length, apart from the columns in ``skip``."""
    total = F.lit(0).cast("bigint")
    for field in df.schema:
        if field.name in skip:
            continue
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            size = F.size(c) * 8
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            continue
        total = total + F.coalesce(size, F.lit(0))
    return total


def vector_contract(df: DataFrame, vec: str) -> DataFrame:
    """One-row report: rows, narrowest and widest vector, rows that break the contract."""
    size = F.size(vec)
    bad = F.col(vec).isNull() | (size == 0) | F.exists(vec, lambda x: x.isNull())
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(size).cast("bigint").alias("min_width"),
        F.max(size).cast("bigint").alias("max_width"),
        F.count_if(bad).alias("bad_rows"),
    )
