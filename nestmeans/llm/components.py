"""Connected components of a table of links, without collecting any of it.

Each round maps every node to the first of itself and its neighbours in the order of a hash and contracts
the links to those. In a random order a constant share of the nodes goes in every round, also on
chains, so the number of rounds is logarithmic. The map of a round is written before it is joined,
so both sides of each join are plain shuffles that Spark can split at hubs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.scratch import checkpoint

MAX_ROUNDS = 100


def components(links: DataFrame, a: str = "a", b: str = "b", smallest: bool = True) -> DataFrame:
    """``(node, component)`` for every linked node; the component is its smallest node, or with
    ``smallest=False`` any one of its nodes, which saves two steps.

    NULL ends are dropped, self links make a component of one, repeats and directions do not matter.
    """
    def both_ways(df: DataFrame) -> DataFrame:
        return df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    maps: list[DataFrame] = []
    for _ in range(MAX_ROUNDS):
        first = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("x"))).alias("f")
        parent = both_ways(links).groupBy("a").agg(first)
        parent = parent.select(
            F.col("a").alias("node"), F.least(F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("x")), "f")["x"].alias("p")
        )
        parent = checkpoint(parent)
        maps.append(parent)
        left = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        # a link to the parent itself contracts to (p, parent of p)
        links = links.join(left, "a").join(right, "b").where("pa <> pb")
        links = checkpoint(links.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        if links.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    labels = maps[-1].select("node", F.col("p").alias("component"))
    for earlier in reversed(maps[:-1]):
        later = labels.select(F.col("node").alias("p"), "component")
        labels = earlier.join(later, "p", "left").select("node", F.coalesce("component", "p").alias("component"))
        labels = checkpoint(labels)
    if not smallest:
        return labels
    least = checkpoint(labels.groupBy("component").agg(F.min("node").alias("least")))
    return labels.join(least, "component").select("node", F.col("least").alias("component"))
