"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connects neighbours of each node to the smallest of node and neighbours: the larger
    neighbours (``large``), or the smaller ones with the node itself.  Minima are written before
    the join, which can then split the links of a node that has very many."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter("b < a")
        least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that ``node`` reaches over links (a, b) of
    longs.  Each round is written to the shared folder; the rounds grow with the logarithm
    of the longest path.  Nodes without links are not listed."""
    edges = written(edges.filter("a <> b"), "links")
    before = None
    while True:
        edges = written(_star(_star(edges, True), False), "round")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
