"""Connected components of an edge table by alternating large and small stars.

Every round is joins and partial aggregates on plain rows: no adjacency list is ever collected, so a
node with a third of all links costs no more than its rows (the aggregated side of each join is
written first, so AQE can split the skewed partitions of the other).  The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, saved


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``edges`` has two long columns ``a``, ``b`` (null or equal ends are ignored).  Returns
    ``node``, ``root`` for every node with a link, root the smallest node it reaches (for the
    smallest node itself there is no row)."""
    cur = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct())
    cur = checkpointed(cur)
    before = None
    for _ in range(rounds):
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "large")
        root = saved(large.groupBy("u").agg(F.min("v").alias("m")), "roots")
        small = large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = checkpointed(small.unionAll(root.select("u", F.col("m").alias("v"))).distinct())
        now = cur.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"),
                      F.expr("sum(pmod(xxhash64(v, u), 1000003))")).first()
        if now == before:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
