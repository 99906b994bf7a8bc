"""Facts about an assignment: sizes, empty clusters, row conservation, representatives."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.functions.rules import k2_expr
from nestmeans.schemas import require_columns

_HELD = 100_000


def cluster_sizes(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def group_counts(
    df: DataFrame, key: str, method: str = "ratio", value: float = 8.0, base_k: int = 2
) -> DataFrame:
    """Rows and number of sub-clusters of every group."""
    sizes = cluster_sizes(df, key)
    return sizes.withColumn("k2", k2_expr("n", method, value, base_k))


def empty_clusters(df: DataFrame, cluster: str, k: int) -> DataFrame:
    """Ids in 0..k-1 that no row has."""
    ids = df.sparkSession.range(k).select(F.col("id").cast("int").alias(cluster))
    return ids.join(df.select(cluster).distinct(), cluster, "left_anti")


def valid_clusters(df: DataFrame, cluster: str, k: int) -> DataFrame:
    """Rows with an id in 0..k-1."""
    return df.filter((F.col(cluster) >= 0) & (F.col(cluster) < k))


def conservation(rows_in: DataFrame, assigned: DataFrame, cluster: str, k: int) -> DataFrame:
    """One row: rows in, rows saved, rows with an invalid id, requested / effective / used k."""
    id_ = F.col(cluster)
    valid = (id_ >= 0) & (id_ < k)
    saved = cluster_sizes(assigned, cluster).agg(
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("rows_saved"),
        F.coalesce(F.sum(F.when(~F.coalesce(valid, F.lit(False)), F.col("n"))), F.lit(0))
        .alias("rows_invalid"),
        F.count_if(valid).alias("k_non_empty"),
    )
    total = rows_in.agg(F.count(F.lit(1)))
    return saved.withColumn("rows_in", total.scalar()).select(
        "rows_in",
        "rows_saved",
        "rows_invalid",
        F.lit(k).cast("bigint").alias("k_requested"),
        F.least(F.lit(k).cast("bigint"), "rows_in").alias("k_effective"),
        "k_non_empty",
        (F.col("rows_in") == F.col("rows_saved")).alias("conserved"),
    )


def nearest_candidates(df: DataFrame, keys: list[str], dist: str, order: list[str]) -> DataFrame:
    """Per task the row that is first by ``dist`` and ``order`` of every group it meets: a superset of the first rows.

    A task keeps one row per group, up to ``_HELD`` of them; with more groups it passes on what it has and begins
    anew, so its memory is bounded and only a group that returns is sent twice.
    """
    by = [(c, "ascending") for c in (*keys, dist, *order)]

    def first(table: pa.Table) -> pa.Table:
        # positions only: other columns may be of types that Arrow cannot group
        small = table.select([*keys, dist, *order])
        places = pc.sort_indices(small, sort_keys=by, null_placement="at_start")
        ordered = small.select(keys).take(places).append_column("_place", places)
        found = ordered.group_by(keys, use_threads=False).aggregate([("_place", "first")])
        return table.take(found["_place_first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(first(pa.Table.from_batches([batch])))
                rows += held[-1].num_rows
            if rows > _HELD:
                held = [first(pa.concat_tables(held))]
                rows = held[0].num_rows
                if 2 * rows > _HELD:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from first(pa.concat_tables(held)).to_batches()

    return df.mapInArrow(run, df.schema)


def representatives(
    df: DataFrame, keys: list[str], dist: str, order: list[str], carry: list[str] | None = None
) -> DataFrame:
    """The nearest row of every group; ties go to the lowest ``order``, NaN and NULL never win.

    Every task first picks its own candidates, so only those are shuffled and sorted: one row per group and
    task, and a hot group stays cheap.
    """
    require_columns(df, *keys, dist, *order)
    carry = carry or [c for c in df.columns if c not in keys]
    wanted = [c for c in df.columns if c in {*keys, *carry, dist, *order}]
    found = df.select(*wanted).filter(F.col(dist).isNotNull() & ~F.isnan(dist))
    found = nearest_candidates(found, keys, dist, order)
    nearest = F.min_by(F.struct(*carry), F.struct(dist, *order))
    best = found.groupBy(*keys).agg(nearest.alias("row"))
    return best.select(*keys, "row.*").select(*[c for c in df.columns if c in {*keys, *carry}])
