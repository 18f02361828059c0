"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on (u, v) with v < u or either way round: neighbours are hung on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    around = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = around.join(least, "u")
    hung = met.filter(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        hung = hung.unionByName(least.select("u", F.col("m").alias("v")))
    return hung.filter("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node of the (u, v) edges; the root is the least node of its component.

    Each round is cut off by a checkpoint in the shared folder. Rounds end when the
    edges no longer change, told by their count and the sum of their hashes.
    """
    now = edges.select("u", "v").filter("u != v").distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        seen = state
        now = _star(_star(now, True), False).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
