"""Row numbers and equal parts over a whole table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestmeans.schemas import require_columns
from nestmeans.scratch import checkpoint

_OFFSET_BITS = 33


def with_ordinal(df: DataFrame, order: list[str], out: str = "rn") -> DataFrame:
    """Number the rows 1..N by ``order``, which should tell all rows apart.

    Rows are range-partitioned, sorted and checkpointed. A row's number is its place in its
    partition plus the rows of the partitions before it; only partition counts are summed.
    """
    require_columns(df, *order)
    placed = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = placed.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", _OFFSET_BITS).alias("_part")
    placed = placed.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    skipped = (
        placed.groupBy("_part").count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_skip"))
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)) + F.lit(1)
    return (
        placed.join(F.broadcast(skipped), "_part")
        .withColumn(out, place + F.col("_skip"))
        .drop("_id", "_part", "_skip")
    )


def split_parts(df: DataFrame, n: int, order: list[str], out: str = "part") -> DataFrame:
    """Ordered parts 1..n of ceil(N / n) rows each; the last part takes the rest."""
    if n < 1:
        raise ValueError("n must be >= 1")
    size = max(1, -(-df.count() // n))
    place = F.floor((F.col("_rn") - 1) / F.lit(size))
    part = (F.least(place, F.lit(n - 1)) + 1).cast("int")
    return with_ordinal(df, order, "_rn").withColumn(out, part).drop("_rn")
