"""Connected components of a link table, by alternating star contraction.

Each round lets every node point to the smallest id that it sees: first larger neighbours are
hooked to a node's smallest neighbour, then smaller ones. Both halves are plain aggregations and
joins on the node, so a node with very many links is pre-aggregated map-side and its join is
split by AQE. The edges never grow beyond their first number, and the number of rounds grows
with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)``, the component being its smallest node.

    Nodes without links are absent. Null ends and self links are ignored; repeated and reversed
    links count once; no links give no rows. Raises if ``max_rounds`` is not enough.
    """
    edges = cut_lineage(links.where("a <> b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = large.distinct()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        small = (star.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        new = cut_lineage(small)
        same = (new.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
                .join(new.select(F.col("b").alias("r")).distinct(), F.col("a") == F.col("r"), "left")
                .where("n > 1 or r is not null").isEmpty())
        edges = new
        if same:                                   # every node points at one root, no root points on
            return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
