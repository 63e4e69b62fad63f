"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut

#: Rounds after which something is wrong: every round at least halves the longest chain.
MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for links ``a, b``: the component is its smallest node.

    Each round every node sends its larger neighbours, then its smaller ones, to the smallest node it sees. Minima are
    combined before the shuffle, so a node with very many links is no hot group. Empty links give an empty table.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(MOST_ROUNDS):
        # Large star: larger neighbours of a node are linked to its smallest neighbour or itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: smaller neighbours and the node itself are linked to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
