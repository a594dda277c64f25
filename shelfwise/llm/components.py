"""Connected components of a table of links, by joins and grouped minima."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _minima(rows: DataFrame) -> DataFrame:
    """Every neighbour of a node tied to the least of its neighbourhood: rows (node, near), both directions wanted."""
    least = rows.groupBy("node").agg(F.min("near").alias("least"))
    return rows.join(least, "node").select("node", "near", F.least("node", "least").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of `links` (long columns a, b): root is the least node that it reaches.

    Alternates the two star steps (tie larger neighbours to the least one, then smaller ones) until every node
    hangs on its root; each is a map-side reduced minimum and a join, whose large keys AQE splits, so the
    centre of a large star is never gathered. The rounds grow with the logarithm of the longest path.
    """
    edges = stage(_ordered(links), "links")
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        large = _ordered(_minima(both).where("near > node").select(F.col("near").alias("a"), F.col("least").alias("b")))
        down = large.select(F.col("a").alias("node"), F.col("b").alias("near"))
        tied = _minima(down)
        small = tied.select(F.col("near").alias("a"), F.col("least").alias("b")).unionByName(tied.select(F.col("node").alias("a"), F.col("least").alias("b")))
        fresh = stage(_ordered(small), "links")
        # done when no node both hangs on another and has one hanging on it, and each hangs on one
        state = fresh.agg(F.count("*").alias("n"), F.countDistinct("a").alias("nodes")).first()
        deep = fresh.select("a").join(fresh.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        edges = fresh
        if not deep and state["n"] == state["nodes"]:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
