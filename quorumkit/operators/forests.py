"""Spanning forests and average linkage of weighted pairs, as joins; no task ever holds a matrix.

Pairs are tables with a group (several graphs at once), two nodes and a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize

#: Rounds after which an unsettled graph is an error; every round at least halves what is left.
MOST_ROUNDS = 64


def _roots(pointers: DataFrame) -> DataFrame:
    """(g, c, root) of pointers (g, c, d): where each chain ends. Of two nodes that point at each other the smaller is the root."""
    other = pointers.select("g", F.col("c").alias("d"), F.col("d").alias("back"))
    now = materialize(pointers.join(other, ["g", "d"], "left").select("g", "c", F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("d")), F.col("c")).otherwise(F.col("d")).alias("d")))
    for _ in range(MOST_ROUNDS):
        ahead = now.select("g", F.col("c").alias("d"), F.col("d").alias("next"))
        now = materialize(now.join(ahead, ["g", "d"], "left").select("g", "c", F.coalesce("next", "d").alias("next"), "d"))
        moved = now.where("next <> d").limit(1).count()
        now = now.select("g", "c", F.col("next").alias("d"))
        if not moved:
            return now.withColumnRenamed("d", "root")
    raise RuntimeError("pointers did not settle")


def spanning_forest(edges: DataFrame) -> DataFrame:
    """The edges (g, a, b, w) of each group's maximum spanning forest, with a < b.

    Boruvka's rounds: every component takes its heaviest edge to another one,
    and components that meet become one. Of equal weights the edge with the
    smaller a, then the smaller b, is the heavier, so the forest is the only one.
    Direction does not count, of parallel edges the heaviest stays; self-loops
    and null weights are left out; no edges give no rows.
    """
    plain = edges.where("a <> b AND w IS NOT NULL").groupBy("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("w").alias("w"))
    plain = materialize(plain)
    taken, crossing = None, materialize(plain.select("*", F.col("a").alias("ca"), F.col("b").alias("cb")))
    for _ in range(MOST_ROUNDS):
        ends = crossing.select("g", F.col("ca").alias("c"), F.col("cb").alias("d"), "a", "b", "w").unionByName(crossing.select("g", F.col("cb").alias("c"), F.col("ca").alias("d"), "a", "b", "w"))
        best = materialize(ends.groupBy("g", "c").agg(F.min(F.struct((-F.col("w")).alias("down"), "a", "b", "d")).alias("e")).select("g", "c", "e.*"))
        if not best.limit(1).count():
            break
        chosen = best.select("g", "a", "b", (-F.col("down")).alias("w")).distinct()
        taken = chosen if taken is None else taken.unionByName(chosen)
        root = _roots(best.select("g", "c", "d"))
        for side in ("ca", "cb"):
            crossing = crossing.join(root.select("g", F.col("c").alias(side), F.col("root").alias(f"{side}_root")), ["g", side])
        crossing = materialize(crossing.where("ca_root <> cb_root").select("g", "a", "b", "w", F.col("ca_root").alias("ca"), F.col("cb_root").alias("cb")))
    return plain.limit(0) if taken is None else taken


def average_linkage(nodes: DataFrame, distances: DataFrame, min_size: int = 2, max_size: int = 100) -> DataFrame:
    """(g, node, cluster): average-linkage clusters, max(n // min_size, ceil(n / max_size)) of each group's n nodes, named by their least node.

    distances: (g, a, b, d) of pairs of nodes, each once; pairs that are missing
    count as infinitely far. Rounds merge all reciprocal nearest neighbours at
    once, which for average linkage gives the same tree as one merge after the
    other; then the lowest merges are kept. Of equal distances the smaller nodes
    come first, a pair's smaller node before its larger.
    """
    now = materialize(distances.select("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("d").cast("double").alias("d"), F.lit(1.0).alias("m")).where("a <> b"))
    merges = None
    for _ in range(10_000):
        ends = now.select("g", F.col("a").alias("c"), F.col("b").alias("e"), "a", "b", "d").unionByName(now.select("g", F.col("b").alias("c"), F.col("a").alias("e"), "a", "b", "d"))
        nearest = ends.groupBy("g", "c").agg(F.min(F.struct("d", "a", "b")).alias("n")).select("g", "n.*")
        # a pair that is nearest for both of its ends stands here twice
        pairs = materialize(nearest.groupBy("g", "a", "b", "d").agg(F.count(F.lit(1)).alias("n")).where("n = 2").drop("n"))
        if not pairs.limit(1).count():
            break
        merges = pairs if merges is None else merges.unionByName(pairs)
        into = pairs.select("g", F.col("b").alias("old"), F.col("a").alias("new"))
        for side in ("a", "b"):
            named = into.select("g", F.col("old").alias(side), F.col("new").alias(f"{side}_new"))
            now = now.join(named, ["g", side], "left").withColumn(side, F.coalesce(f"{side}_new", side)).drop(f"{side}_new")
        total = F.sum("m")
        now = materialize(now.where("a <> b").groupBy("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg((F.sum(F.col("d") * F.col("m")) / total).alias("d"), total.alias("m")))
    sizes = nodes.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.least(F.col("n"), F.greatest(F.floor(F.col("n") / max(1, min_size)), F.ceil(F.col("n") / max(1, max_size)), F.lit(1)))
    alone = nodes.select("g", "node", F.col("node").alias("cluster"))
    if merges is None:
        return alone
    low = running_sum(merges, ["g"], ["d", "a", "b"], name="place").join(sizes.withColumn("cut", F.col("n") - wanted), "g").where("place < cut")
    # a cluster's name is its least node, so a merge points from b to a and chains end at the least node of all
    pointers = low.select("g", F.col("b").alias("c"), F.col("a").alias("d"))
    root = _roots(pointers)
    return alone.join(root.select("g", F.col("c").alias("node"), "root"), ["g", "node"], "left").select("g", "node", F.coalesce("root", "cluster").alias("cluster"))
