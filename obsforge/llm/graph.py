"""Connected components of a large graph by contraction, on Spark tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.session import written


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every end of the links (x, y): root is the smallest id reachable. Loops and repeated links are harmless.

    Each round hangs every node under its smallest neighbour, shortens the chains by pointer jumping, and keeps only links
    between different roots; at least half of the nodes that still have links disappear in a round.
    """
    edges = written(links.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("x").alias("id"), F.col("y").alias("b")).union(edges.select(F.col("y").alias("id"), F.col("x").alias("b")))
        hung = written(ends.groupBy("id").agg(F.least(F.col("id"), F.min("b")).alias("root")), "hung")
        while True:
            above = hung.select(F.col("id").alias("root"), F.col("root").alias("top"))
            hop = written(hung.join(above, "root").select("id", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "hop")
            hung = hop.select("id", "root")
            if hop.where("moved").isEmpty():
                break
        if labels is None:
            labels = hung
        else:
            above = hung.select(F.col("id").alias("root"), F.col("root").alias("top"))
            labels = written(labels.join(above, "root", "left").select("id", F.coalesce("top", "root").alias("root")), "labels")
        left = hung.select(F.col("id").alias("x"), F.col("root").alias("rx"))
        right = hung.select(F.col("id").alias("y"), F.col("root").alias("ry"))
        kept = edges.join(left, "x").join(right, "y").where("rx <> ry")
        edges = written(kept.select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct(), "links")
    return labels if labels is not None else edges.select(F.col("x").alias("id"), F.col("y").alias("root"))
