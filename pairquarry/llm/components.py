"""Connected components by large-star and small-star rounds; every round is two aggregations, cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): each linked node and the smallest node that it reaches. links: pairs of orderable nodes.

    Only minima are gathered for a node, never its neighbours, so that no task holds a hub. Rounds are logarithmic in
    the longest chain; a count of changed rows is all that reaches the driver.
    """
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node is linked to the least of the node and its neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")  # so that the join deals out a hub's rows and AQE can split them
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        # Small star: a node and its smaller neighbours are linked to the least of them. All rows of large have u > v.
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("x"), "m").union(low.select(F.col("u").alias("x"), "m")).where("x <> m").distinct()
        after = materialize(small.select(F.col("x").alias("u"), F.col("m").alias("v")), "small-star")
        state = [d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first() for d in (edges, after)]
        if state[0] == state[1]:
            break
        edges = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).union(after.select(F.col("v"), F.col("v"))).distinct()
