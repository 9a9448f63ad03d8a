"""Connected components by alternating large-star and small-star steps.

No component is ever gathered: a step is a group-by over edges and a join of its result with the edges.
Labels are the least node of each component. Edges are written to the shared folder at each round, which
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise


def _least(edges: DataFrame) -> DataFrame:
    """Of edges (a, b): each a with ``m``, the least of it and its neighbours b."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large(both: DataFrame, least: DataFrame) -> DataFrame:
    """Each node's larger neighbours linked to the least of its neighbourhood; edges in both directions."""
    joined = both.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours linked to the least of them. No hub meets here: after a large step it
    is the smaller end of its edges."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    joined = down.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether the edges (a larger than b) are stars: every a has one b, and no b is an a."""
    sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select(F.col("b"), F.lit(0), F.lit(1)))
    return sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (a, b) of one ordered type -> (node, root): the least node of each node's component,
    for nodes with an edge to another. Repeated edges and loops are allowed."""
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        if _stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # as a table of its own, so that the join is one of plain tables, and AQE can split a hub's edges over tasks
        least = materialise(_least(both), "least")
        after = materialise(_small(_large(both, least)), "edges")
        forget(now)
        forget(least)
        now = after
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
