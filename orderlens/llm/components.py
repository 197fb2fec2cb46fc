"""Connected components of an undirected link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _pointed(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both directions of the edges, and each node's least neighbour or itself."""
    both = edges.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
                                          F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    return both, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star: four exchanges and a distinct."""
    both, least = _pointed(edges)
    # greater neighbours, and each node itself, point at the least node seen
    large = both.join(least, "u").select(F.when(F.col("v") > F.col("u"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v")
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    # a node's other neighbours point at its least one; the node itself does too
    small = large.join(low, "u").select(F.explode(F.array_distinct(F.array("u", "v"))).alias("u"), F.col("m").alias("v"))
    return small.where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every component is a star: no node both points and is pointed at, and none points twice."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e"))
    per_node = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.count(F.lit(1)).alias("all"))
    return not per_node.agg(F.max((F.col("out") > 1) | (F.col("out") == 1) & (F.col("all") > 1))).first()[0]


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``links``; component is the least node id reachable.

    Alternating stars (large, then small): each half-round points neighbours at the least node
    they see, so paths shrink by a constant factor and the edge count never grows. Every round
    is written to the shared folder, which cuts the lineage; the driver reads one truth value a
    round. Duplicate links, self-links and an empty table are fine.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(edges):
            break
        edges = materialize(_round(edges), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.explode(F.array(a, b)).alias("node")).distinct()
    return roots.join(edges.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
