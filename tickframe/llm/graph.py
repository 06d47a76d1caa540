"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.session import cut_and_measure

# Edges for each task: a small graph is not dealt over all partitions in every round.
ROWS_PER_TASK = 100_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for all nodes of ``edges`` (a, b), by alternating stars.

    Every node first links its larger neighbours to the smallest one it knows, then its smaller ones; the edges become
    stars after a number of rounds that grows with the logarithm of the nodes. No round gathers a node's neighbours.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    measures = {"rows": F.count(F.lit(1)), "digest": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    stars, before = cut_and_measure(edges.where("a <> b").select(larger, smaller).distinct(), **measures)
    while True:
        tasks = 1 + before["rows"] // ROWS_PER_TASK
        both = stars.union(stars.select("b", "a")).toDF("u", "v").coalesce(tasks)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        stars = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = stars.groupBy("a").agg(F.min("b").alias("m"))
        joined = stars.join(low, "a")
        stars = joined.where("b <> m").select(F.col("b").alias("a"), "m").union(joined.select("a", "m")).toDF("a", "b").coalesce(tasks).distinct()
        stars, now = cut_and_measure(stars, **measures)
        if now == before:
            break
        before = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(stars.select(F.col("b"), F.col("b")).distinct())
