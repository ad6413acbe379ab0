"""Data-category tree selection (F-18).

A category tree is labelled once, when its group is registered: each node gets its
path, the node itself and all its ancestors, by pointer jumping (a round doubles the
stretch of every path, so a tree of depth d takes log d rounds).  With paths
a selector is a test on each node: BELOW some nodes are those whose path meets them,
ABOVE them is what their own paths hold.  No job runs while a query is built.

A graph that is no tree (a node with several parents, or a cycle) has no paths; there
the part that a selector needs is walked, a level at a time, each node once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def _nodes(edges: DataFrame) -> DataFrame:
    return (edges.select(F.col("child").alias("node"))
            .unionByName(edges.select(F.col("parent").alias("node"))).distinct())


def _walk(edges: DataFrame, seeds: DataFrame, down: bool) -> DataFrame:
    """``seeds`` and all nodes reached from them, level by level until a level
    brings no new node: any depth, cycles included.  Each level is a written
    table, so plans stay short."""
    spark = edges.sparkSession
    step_from, step_to = ("parent", "child") if down else ("child", "parent")

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "category")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    level = seen = kept(seeds.select("node"))
    hops = edges.select(F.col(step_from).alias("node"), F.col(step_to).alias("next"))
    while True:
        reached = level.join(hops, "node").select(F.col("next").alias("node")).where("node is not null").distinct()
        level = kept(reached.join(seen, "node", "left_anti"))
        if level.isEmpty():
            return seen
        seen = kept(seen.unionByName(level))


#: rounds of pointer jumping between two written tables
ROUNDS_AT_ONCE = 2


def tree_paths(edges: DataFrame) -> DataFrame | None:
    """(node, path) of a forest given as (child, parent) rows: ``path`` begins
    with the node and ends with its root.  Null parents and self-references
    count as none.  None if the graph is no forest."""
    spark = edges.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "category-paths")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    up = edges.where("child is not null AND parent is not null AND child <> parent")
    ends = up.select(F.explode(F.array(F.struct(F.col("child").alias("node"), F.col("parent").alias("top")),
                                       F.struct(F.col("parent").alias("node"), F.lit(None).cast("string").alias("top")))).alias("e")).select("e.*")
    alone = edges.where("child is not null AND (parent is null OR child = parent)").select(F.col("child").alias("node"), F.lit(None).cast("string").alias("top"))
    base = (ends.unionByName(alone).groupBy("node").agg(F.min("top").alias("top"), (F.min("top") != F.max("top")).alias("split"))
            .select("node", F.array("node").alias("path"), "top", F.coalesce("split", F.lit(False)).alias("split")))
    level, stretch = kept(base), 1
    while True:
        rest = level.agg(F.count(F.lit(1)).alias("n"), F.count("top").alias("open"), F.max("split").alias("split")).first()
        if rest["split"] or (rest["open"] and stretch > rest["n"]):
            return None     # several parents; or a path longer than there are nodes
        if not rest["open"]:
            return level.select("node", "path")
        for _ in range(ROUNDS_AT_ONCE):
            above = level.select(F.col("node").alias("top"), F.col("path").alias("more"), F.col("top").alias("next"))
            level = level.join(above, "top", "left").select(
                "node", F.when(F.col("more").isNotNull(), F.concat("path", "more")).otherwise(F.col("path")).alias("path"),
                F.col("next").alias("top"), "split")
            stretch *= 2
        level = kept(level)


def closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(ancestor, descendant) for every node and each of its ancestors,
    including (node, node)."""
    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "category")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    level = seen = kept(_nodes(edges).where("node is not null").select(F.col("node").alias("ancestor"), F.col("node").alias("descendant")))
    up = edges.where("parent is not null").select(F.col("child").alias("ancestor"), F.col("parent").alias("next"))
    while not level.isEmpty():
        reached = level.join(up, "ancestor").select(F.col("next").alias("ancestor"), "descendant").distinct()
        level = kept(reached.join(seen, ["ancestor", "descendant"], "left_anti"))
        seen = kept(seen.unionByName(level))
    return seen


def category_nodes(spark: SparkSession, edges: DataFrame, selector: str, names: list[str],
                   paths: DataFrame | None = None) -> DataFrame:
    """Nodes a selector admits: AT = the named nodes; ABOVE = them and their
    ancestors; BELOW = them and their descendants; ABOVE_OR_BELOW = both.
    With the ``paths`` of :func:`tree_paths` this is a lazy plan."""
    if paths is not None:
        named = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        below = paths.where(F.arrays_overlap("path", named)).select("node")
        above = paths.where(F.array_contains(named, F.col("node"))).select(F.explode("path").alias("node"))
        return {"AT": paths.where(F.array_contains(named, F.col("node"))).select("node"), "BELOW": below, "ABOVE": above.distinct(),
                "ABOVE_OR_BELOW": below.unionByName(above).distinct()}[selector]
    seeds = _nodes(edges).filter(F.col("node").isin(list(names)))
    if selector == "AT":
        return seeds
    parts = []
    if selector in ("BELOW", "ABOVE_OR_BELOW"):
        parts.append(_walk(edges, seeds, down=True))
    if selector in ("ABOVE", "ABOVE_OR_BELOW"):
        parts.append(_walk(edges, seeds, down=False))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
