"""Connected components of a link table, by alternating star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.sources.checkpoint import materialize


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of a link; component is its part's smallest node.

    Large-star and small-star steps (Kiveris et al. 2014): each node points its
    neighbours at the smallest one it knows. The number of rounds grows with the
    logarithm of the longest path. Minima are taken map-side, each round is written to
    the shared folder, and the driver sees two numbers a round.
    """
    pairs = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: smaller neighbours of u, and u itself, go to the smallest of them.
        star = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = materialize(star.filter("u <> v").distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(now):
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
