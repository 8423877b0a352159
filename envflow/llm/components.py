"""Connected components of a graph held as a table of edges, by alternating large-star and small-star steps.

Every step is joins and partially aggregated minima on DataFrames. Each step's edges are written to the shared
folder, so lineage stays short and a lost executor costs only a task. A hub node is never gathered: its minimum
is a partial aggregate, and its join rows are split by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, splittable, written


def _large_star(edges: DataFrame, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """edges: (a, b) with a > b. Every larger neighbour of a node is linked with the node's smallest neighbour or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")))
    return both.join(least, F.col("u") == F.col("k")).where("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """edges: (a, b) with a > b. Every smaller neighbour, and a itself, is linked with a's smallest neighbour."""
    least = kept(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every a of (a, b) has one edge and none is a b: then each b is its component's smallest node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("larger"), F.lit(0).alias("smaller")).unionAll(edges.select(F.col("b").alias("node"), F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return ends.where("larger > 1 OR larger = 1 AND smaller = 1").isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b), component being its smallest reachable node.

    Self-loops and repeated edges do no harm; rows with a null end are ignored. A node whose only edge is a
    self-loop is not returned. Raises if the components are not stars after most_rounds rounds (they grow with the
    logarithm of the longest path).
    """
    now = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    for _ in range(most_rounds):
        rows, passing = now.count(), []
        if not rows or _is_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

        def kept(table: DataFrame, rows: int = rows, passing: list = passing) -> DataFrame:
            passing.append(splittable(table, "minima", rows))
            return passing[-1]

        large = splittable(_large_star(now, kept), "edges", rows)
        before, now = now, written(_small_star(large, kept), "edges", rows)
        discard(before, large, *passing)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
