"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: edges that a task writes, unless there are more cores than such parts
EDGES_IN_PART = 100_000


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for all nodes
    that occur in ``edges`` (``a``, ``b``: longs; a written table, as it is read twice).

    Edges point from the larger node to the smaller one.  Each round points
    every edge at the smallest neighbour of its smaller end, then every node's
    smaller neighbours at the smallest of them, until a round changes nothing: the
    edges are stars.  Rounds grow with the logarithm of the longest path; every
    round is one written table, in parts of ``EDGES_IN_PART`` edges, and nothing goes
    through the driver."""
    cores, size = edges.sparkSession.sparkContext.defaultParallelism, edges.count()
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # of equal edges one that moved comes first, and stays
    of_node = Window.partitionBy("a").orderBy("b", F.desc("moved"))
    for _ in range(most_rounds):
        lowest = now.groupBy(F.col("a").alias("b")).agg(F.min(F.col("b")).alias("m"))
        large = now.join(lowest, "b", "left").select("a", F.coalesce("m", "b").alias("b"), F.col("m").isNotNull().alias("moved"))
        small = large.select("a", "b", "moved", F.first("b").over(of_node).alias("m"), F.lag("b").over(of_node).alias("before"))
        small = small.where("before is null or before <> b").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"), F.expr("moved or b <> m").alias("moved"))
        small = stage(small.coalesce(max(cores, -(-size // EDGES_IN_PART))), "edges")
        now = small.select("a", "b")
        size, moved = small.agg(F.count(F.lit(1)), F.max("moved")).first()
        if not moved:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
