"""Ancestors at a rank, rollups and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumkit.functions.labels import canonical_label
from quorumkit.sinks.shared import materialize

def ancestors_at_ranks(nodes: DataFrame, ranks: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """(at_rank, tax_id, ancestor): for each rank the nearest node of it at or above each node.

    Pointers double: a node of the rank and a root point at themselves, others
    at their parent, and following each pointer's pointer doubles its reach.
    Four pointers are followed before the result is written to the shared
    folder, until none moves, so a tree of any depth d takes about log4(d)
    short plans. Nodes without such an ancestor are left out; pointers that still
    move after as many steps as there are nodes are an error.
    """
    rank_list = F.array(*map(F.lit, ranks)) if ranks else F.array().cast("array<string>")
    here = nodes.select(F.explode(rank_list).alias("at_rank"), "tax_id", "parent", "rank")
    stays = (F.col("rank") == F.col("at_rank")) | (F.col("parent") == F.col("tax_id"))
    hop = materialize(here.select("at_rank", "tax_id", F.when(stays, F.col("tax_id")).otherwise(F.col("parent")).alias("hop")))

    def follow(a: DataFrame, b: DataFrame) -> DataFrame:
        step = b.select(F.col("at_rank").alias("r"), F.col("tax_id").alias("t"), F.col("hop").alias("h"))
        return a.join(step, (F.col("at_rank") == F.col("r")) & (F.col("hop") == F.col("t")), "left").select("at_rank", "tax_id", F.coalesce("h", "hop").alias("hop"), *(["was"] if "was" in a.columns else []))

    reach, most = 2, nodes.count()
    while True:
        twice = materialize(follow(hop.withColumn("was", F.col("hop")), hop))
        moved = twice.where("hop <> was").limit(1).count()
        hop = twice.drop("was")
        if not moved:
            break
        if reach > 2 * most:  # the pointers before reached beyond every node
            raise ValueError("parents form a cycle")
        hop = materialize(follow(hop, hop))
        reach *= 4
    if wanted is not None:
        hop = hop.join(wanted.select("tax_id").distinct(), "tax_id", "left_semi")
    ranked = nodes.select(F.col("rank").alias("at_rank"), F.col("tax_id").alias("hop"))
    return hop.join(ranked, ["at_rank", "hop"], "left_semi").select("at_rank", "tax_id", F.col("hop").alias("ancestor"))


def ancestor_at_rank(nodes: DataFrame, rank: str, wanted: DataFrame | None = None) -> DataFrame:
    """(tax_id, ancestor): the nearest node of that rank at or above each node that has one."""
    return ancestors_at_ranks(nodes, [rank], wanted).select("tax_id", "ancestor")


def lineage(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tax_id, lineage map rank -> id) of the wanted ids; of equal ranks the one nearest the root holds.

    The list of (id, ancestor, distance) and the pointers both double in reach
    each round and are written to the shared folder, until no pointer is left;
    there is no limit on rows or depth. The root itself is left out; a cycle of
    parents is an error.
    """
    jump = materialize(nodes.where("parent <> tax_id").select(F.col("tax_id").alias("from"), F.col("parent").alias("to")))
    above = wanted.select("tax_id").distinct().join(nodes.select("tax_id").distinct(), "tax_id", "left_semi").select("tax_id", F.col("tax_id").alias("at"), F.lit(0).alias("depth"))
    reach, most = 1, nodes.count()
    while jump.limit(1).count():
        if reach > 2 * most:
            raise ValueError("parents form a cycle")
        further = above.join(jump, F.col("at") == F.col("from")).select("tax_id", F.col("to").alias("at"), F.col("depth") + reach)
        above = materialize(above.unionByName(further.toDF("tax_id", "at", "depth")))
        jump = materialize(jump.join(jump.select(F.col("from").alias("to"), F.col("to").alias("next")), "to").select("from", F.col("next").alias("to")))
        reach *= 2
    named = above.join(nodes.select(F.col("tax_id").alias("at"), "rank", "parent"), "at").where("at <> parent AND at <> 1")
    each = named.groupBy("tax_id", "rank").agg(F.max_by("at", "depth").alias("at"))
    return each.groupBy("tax_id").agg(F.map_from_entries(F.collect_list(F.struct("rank", "at"))).alias("lineage"))


def roll_up(votes: DataFrame, mapping: DataFrame, label: str = "label", keep_unmapped: bool = True) -> DataFrame:
    """Labels of a long vote table through (taxid, mapped).

    Unmapped labels keep themselves (or become null), null stays null. Each
    distinct label is looked up once by the join; Spark broadcasts the mapping
    if it is small.
    """
    joined = votes.withColumn("__c", canonical_label(F.col(label))).join(mapping.select(F.col("taxid").alias("__c"), "mapped"), "__c", "left")
    new = F.coalesce("mapped", "__c") if keep_unmapped else F.col("mapped")
    return joined.withColumn(label, F.when(F.col(label).isNull(), F.lit(None)).otherwise(new)).select(*votes.columns)


def expand_ranks(votes: DataFrame, nodes: DataFrame, ranks: Sequence[str], label: str = "label") -> DataFrame:
    """Votes at several ranks, with the rank as a key column; unmapped labels become null."""
    found = materialize(ancestors_at_ranks(nodes, ranks))
    out = None
    for rank in ranks:
        mapping = found.where(F.col("at_rank") == rank).select(F.col("tax_id").cast("string").alias("taxid"), F.col("ancestor").cast("string").alias("mapped"))
        got = roll_up(votes, mapping, label, keep_unmapped=False).withColumn("rank", F.lit(rank))
        out = got if out is None else out.unionByName(got)
    return out


def label_names(labels: DataFrame, *tables: DataFrame) -> DataFrame:
    """(taxid, name) through several (taxid, name) tables, the first that knows it; else the label itself."""
    out, names = labels.select("taxid").distinct(), []
    for i, t in enumerate(tables):
        out = out.join(t.select("taxid", F.col("name").alias(f"__n{i}")), "taxid", "left")
        names.append(F.col(f"__n{i}"))
    return out.select("taxid", F.coalesce(*names, F.col("taxid")).alias("name"))
