"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Rounds after which an unsettled graph is an error; each round halves the depth, so 60 covers any graph.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its least neighbour (itself included)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for nodes with an edge.

    edges: columns a and b of one ordered type, in any order; self-loops, nulls
    and repeats are ignored; no edges give no rows. Large-star and small-star
    rounds alternate until every edge points at a root. Each round is written to
    the shared folder, so the plan stays short and a lost executor costs one round.
    """
    clean = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(clean)
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now)))
        # settled when the graph is a set of stars: no node that points away is pointed at, none points twice
        roots = now.select(F.col("b").alias("a")).distinct()
        deep = now.join(roots, "a", "left_semi").limit(1).count()
        twice = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not deep and not twice:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError("components did not settle")
