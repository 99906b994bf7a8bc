"""Merkle manifest of a dataset: a root per group and one over all groups, with a proof for every row.

Rows become leaves, hashed in the scan; only digests move after that. Per group the leaves stand in
order of their id, numbered by range partitions and partition counts, so that no sort or window holds
a group. Then level by level each node is shifted to its run's first place by a self-join on the
computed sibling index: ``index XOR 1`` in a binary tree, ``index - slot`` for the slots above
zero of a wider one. The rows of slot zero have then met all their siblings and emit the parent. The
top one or two levels of a group cost as much as any other in plan but next to nothing in rows. The
roots of the groups, in order of the group, are built into the root of all in the same way.

Proofs go the other way, from the root down: the path of a node is its own siblings and the path of its
parent, so a leaf's path is put together in one join with the runs and never written: each run carries
the path of its parent, 1 / arity of the rows.

Joins are by (group, index), which is different for every row, so a hot group spreads like any other.

Defined cases: NULL columns are hashed as ``-``; rows of NULL group come first and are one group, NULL ids
come before all others; rows that are equal in id are ordered by their leaf; equal rows are leaves each; one
row alone is its own subroot and, in a table of one group, root; an empty table gives an empty
result; texts of any length are hashed whole. Columns that are not named are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestmeans.scratch import materialize

ARITY = 8
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the value's length in UTF-8 bytes, a colon, and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return digest(*[encoded(v) for v in values])


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 within ``grp`` in ``order``, and ``n``, the group's rows.

    ``order`` begins with ``grp`` and tells all rows apart, so equal keys are dealt over partitions too.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    # a group's rows lie side by side in a partition: its first place there and the counts tell every place
    part = F.shiftright("at", 33).alias("part")
    counts = placed.groupBy("grp", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    counts = materialize(counts, "counts")
    # one row for each partition that holds some of the group
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "grp", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("c").over(group).alias("n")
    )
    found = placed.withColumn("part", part).join(materialize(starts, "starts"), ["grp", "part"])
    return found.withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """``(grp, run, n, members)`` of ``(grp, idx, n, node)``: the rows of slot zero, with their siblings shifted to them."""
    slot = F.col("idx") % arity
    zero = nodes.where(slot == 0).select("grp", "idx", "n", F.col("node").alias("m0"))
    for s in range(1, arity):
        shifted = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - s
        sibling = nodes.where(slot == s).select("grp", shifted.alias("idx"), F.col("node").alias(f"m{s}"))
        zero = zero.join(sibling, ["grp", "idx"], "left")
    members = F.array_compact(F.array(*[F.col(f"m{s}") for s in range(arity)]))
    return zero.select("grp", F.floor(F.col("idx") / arity).alias("run"), "n", members.alias("members"))


def _climb(nodes: DataFrame, largest: int, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, lowest first, and ``(grp, node)`` of what remains of each group.

    ``largest`` is the number of nodes of the largest group.
    """
    levels, tops = [], []
    while True:
        tops.append(nodes.where("n = 1").select("grp", "node"))
        if largest <= 1:
            return levels, materialize(reduce(DataFrame.unionByName, tops), "tops")
        runs = materialize(_runs(nodes.where("n > 1"), arity), "runs")
        levels.append(runs)
        largest = -(-largest // arity)
        above = F.ceil(F.col("n") / arity)
        nodes = runs.select("grp", F.col("run").alias("idx"), above.alias("n"), digest(F.array_join("members", "")).alias("node"))


def around(members: Column, slot: Column) -> Column:
    """The siblings before and after a slot of a run, each side joined to one text."""
    return F.struct(
        F.array_join(F.slice(members, F.lit(1), slot), "").alias("before"),
        F.array_join(F.slice(members, slot + 2, F.size(members)), "").alias("after"),
    )


def _descend(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """``(grp, run, members, path, ...)`` of the lowest runs; ``path`` is that of the run's parent.

    ``tops`` holds ``(grp, path, ...)`` of every group; further columns come along. A group of one node has
    no run: its row is of run 0 with NULL members.
    """
    rest = [c for c in tops.columns if c not in ("grp", "path")]
    nodes = None
    for runs in reversed(levels):
        # the run on top of a group hangs on the group's own path, the others on their parent node's
        single = F.col("n") <= arity
        found = runs.where(single).drop("n").join(tops, "grp")
        if nodes is not None:
            found = found.unionByName(runs.where(~single).drop("n").join(nodes, ["grp", "run"]))
        below = found.select("grp", "run", "members", "path", *rest, F.posexplode("members").alias("slot", "node"))
        path = F.concat(F.array(around(F.col("members"), F.col("slot"))), F.col("path"))
        nodes = below.select("grp", (F.col("run") * arity + F.col("slot")).alias("run"), path.alias("path"), *rest)
    lone = tops.select("grp", F.lit(0).cast("bigint").alias("run"), F.lit(None).cast("array<string>").alias("members"), "path", *rest)
    if not levels:
        return lone
    return found.unionByName(lone.join(levels[0].select("grp"), "grp", "left_anti"))


def path_of(idx: Column, members: Column, parent: Column, arity: int) -> Column:
    own = F.concat(F.array(around(members, (idx % arity).cast("int"))), parent)
    return F.when(members.isNull(), parent).otherwise(own)


def proof(path: Column) -> Column:
    """Digest of all siblings on the way up, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(p["before"], node, p["after"]))


def manifest(
    rows: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "lang", arity: int = ARITY,
    others: dict[str, Column] | None = None,
) -> DataFrame:
    """``(id, leaf, subroot, root, path)`` of every row, with the columns ``others`` made of the row.

    A row's leaf is the digest of its ``columns`` in that order. ``path`` holds, from the leaf up, the siblings before
    and after the node of each level.
    """
    if arity < 2:
        raise ValueError("arity must be >= 2")
    others = others or {}
    # NULL first: no text that begins with a letter comes before the empty one
    group = F.coalesce(F.concat(F.lit("v"), F.col(group_col).cast("string")), F.lit(""))
    leaves = rows.select(
        group.alias("grp"), F.col(id_col).alias("id"), leaf_of([F.col(c) for c in columns]).alias("node"),
        *[value.alias(f"other_{name}") for name, value in others.items()],
    )
    leaves = materialize(leaves.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    leaves = materialize(_numbered(leaves, ["grp", "id", "node", "salt"]), "numbered")
    nodes = leaves.select("grp", "idx", "n", "node")
    levels, tops = _climb(nodes, nodes.agg(F.max("n")).first()[0] or 0, arity)

    # the same over the subroots, as one group
    groups = tops.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "node")
    groups = materialize(_numbered(groups, ["grp", "name"]), "groups")
    upper, roots = _climb(groups.select("grp", "idx", "n", "node"), groups.count(), arity)
    ends = roots.select("grp", F.array().cast(_PATH).alias("path"), F.col("node").alias("root"))

    def with_paths(nodes: DataFrame, runs: DataFrame) -> DataFrame:
        runs = runs.withColumnRenamed("path", "parent")
        nodes = nodes.withColumn("run", F.floor(F.col("idx") / arity))
        return nodes.join(runs, ["grp", "run"]).withColumn("path", path_of(F.col("idx"), F.col("members"), F.col("parent"), arity))

    paths = with_paths(groups, _descend(upper, ends, arity))
    paths = materialize(paths.select(F.col("name").alias("grp"), "path", "root", F.col("node").alias("subroot")), "paths")
    return with_paths(leaves, _descend(levels, paths, arity)).select(
        F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"other_{name}").alias(name) for name in others],
    )
