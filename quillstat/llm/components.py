"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a long, b long)`` -> ``(node, root)``: root is the smallest node reachable.

    Large star: every node's greater neighbours move to its smallest neighbour;
    small star: its smaller ones do.  The rounds needed grow with the logarithm
    of the number of nodes.  Every round is two pre-aggregated minima and two
    joins on the node, cut at the shared checkpoint folder.  A star's hub is the
    hot key of its join; as the minima are read from files, both sides of the join are plain
    shuffles, which adaptive skew joins split.  Self links, repeated and NULL links
    are dropped; no links give no rows.
    """
    edges = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u > v").distinct()
        low = cut(down.groupBy("u").agg(F.min("v").alias("m")))
        small = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
