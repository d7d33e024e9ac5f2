"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage, unstage

#: A node of fewer edges than this is joined like any other.
LEAST_HOT = 100_000


def on_least(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """``edges (u, v)`` with ``m`` of ``least (u, m, n)``, where ``n`` is the number of a node's edges.

    A node with more edges than two tasks' fair share would hold up one task, so such nodes, at most one
    for each task, are broadcast; the others meet by a shuffle.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(LEAST_HOT, 2 * n_edges // tasks)
    if not n_edges > share or not least.filter(F.col("n") > share).limit(1).count():
        return edges.join(least.select("u", "m"), "u")
    hot = F.broadcast(least.filter(F.col("n") > share).select("u", "m"))
    return edges.join(hot, "u").unionByName(
        edges.join(hot.select("u"), "u", "left_anti").join(least.filter(F.col("n") <= share).select("u", "m"), "u"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a long, b long)``; root is the component's smallest node.

    Each round hangs a node's larger neighbours on its smallest one, then its smaller neighbours, which
    needs a minimum per node and a join, never a node's whole neighbourhood in one place.  Rounds are
    logarithmic in the length of the longest chain; each is written to the shared folder, and its tables are
    deleted after the next.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        n_edges = edges.count()
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        # large star: every larger neighbour of u hangs on u's minimum
        large = on_least(both.filter("v > u"), low, 2 * n_edges).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        # small star: u and its smaller neighbours hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = on_least(large, least, n_edges)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        after = stage(small, "small-star")
        unstage(edges)
        unstage(large)
        # stable once no node is both a child and a parent: then every edge ends in a root
        if after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count() == 0 and \
                after.groupBy("u").count().filter("count > 1").limit(1).count() == 0:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = after
