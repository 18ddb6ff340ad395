"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round only groups by node and joins a one-row-per-node minimum, so a node
with very many neighbours is pre-aggregated before the exchange and its edges
may be split by AQE in the join. Rounds are staged tables in the shared folder;
the number of rounds grows with the logarithm of the longest path, and edges that
are stars around their smallest nodes take none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.staging import staged, unsent


def connected_components(edges: DataFrame, a: str = "src", b: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component): the component is its smallest node. Self-loops are nodes of their own; null ends are ignored."""
    pair = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    whole = staged(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    work = whole.where("u <> v")
    for _ in range(max_rounds):
        if _settled(work):
            break
        # large star: every larger neighbour points at the smallest of the neighbourhood
        both = work.unionByName(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")
        large = both.join(unsent(low), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the node and its smaller neighbours point at the smallest
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        joined = large.join(unsent(low), "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        work = staged(small, "components")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    ends = work.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(work.select(F.col("v").alias("node"), F.col("v").alias("component")))
    loops = whole.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))


def _settled(work: DataFrame) -> bool:
    """Whether the distinct edges (u, v), v < u, are stars: every node has one smaller neighbour at most, and that one has none."""
    up, down = work.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), work.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    return up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()
