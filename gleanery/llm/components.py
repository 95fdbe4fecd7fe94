"""Connected components of a graph given as edges, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.sources.scratch import discard, scratch_path, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half-step: the larger (or smaller) neighbours of each node, linked to the least node near it.

    The least neighbour is a partial aggregate, and the join back is one that
    Spark may split where a node has very many edges; no neighbour list is gathered.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    near = both if large else both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    joined = near.join(least, "a")
    if large:
        linked = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
            least.select("a", F.col("root").alias("b"))
        )
    return linked.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of *edges* (a, b): root is the least node that it reaches.

    Large-star and small-star steps alternate until all edges are stars around least nodes; each
    round's edges are a stored table, which goes with the next one.  Loops and repeated edges do no harm; no edges
    give no rows.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", path)
    while not _stars(now):
        large, small = scratch_path(spark, "large"), scratch_path(spark, "small")
        now = written(_star(written(_star(now, True), "large", large), False), "small", small)
        discard(spark, path, large)
        path = small
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node of *edges* (a, b), a above b, is either the lower end of edges or the upper end of one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("upper")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("upper")))
    met = ends.groupBy("node").agg(F.sum("upper").alias("uppers"), F.min("upper").alias("least"))
    return met.filter("uppers > 1 OR uppers = 1 AND least = 0").limit(1).count() == 0
