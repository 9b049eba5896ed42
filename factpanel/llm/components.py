"""Connected components of links by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factpanel.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of links (a, b) the smallest node that it is connected to.

    Each round lets every node point to its smallest neighbour or itself, follows the
    pointers once more, and replaces the nodes of all links by what they point to. Links
    inside a contracted group go, so the links shrink with every round, until none is left.
    """
    edges = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = stored(ends.select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        points = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        points = stored(points.select(F.col("a").alias("node"), "to"), "points")
        onward = points.select(F.col("node").alias("to"), F.col("to").alias("further"))
        points = stored(points.join(onward, "to").select("node", F.col("further").alias("to")), "points")
        for end in ("a", "b"):
            named = points.select(F.col("node").alias(end), F.col("to").alias("new"))
            edges = edges.join(named, end).drop(end).withColumnRenamed("new", end)
        edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        named = points.select(F.col("node").alias("root"), F.col("to").alias("new"))
        moved = roots.join(named, "root", "left")
        roots = stored(moved.select("node", F.coalesce("new", "root").alias("root")), "roots")
    return roots
