"""Dealing pools of reads out to samples, and planning how many reads to make."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.operators.abundance import available_labels, scale_amounts
from quorumkit.operators.ranking import running_sum


def allocate(requests: DataFrame, available: DataFrame, by: list[str]) -> DataFrame:
    """Deal ``avail`` items out to samples in proportion to their requests.

    requests: by..., sample, pos, req; available: by..., avail. Shares are
    rounded half to even in the order of pos, never beyond what is left, and the
    last sample takes the rest. If nothing is requested, all samples get the
    same, the first ones one more. Adds n, first and last (places in the pool,
    from 1; last is inclusive).
    """
    group = Window.partitionBy(*by)
    order = group.orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = requests.join(available, by).withColumns({"__tot": F.sum("req").over(group), "__m": F.count(F.lit(1)).over(group), "__i": F.row_number().over(order)})
    share = F.bround(F.col("req") / F.col("__tot") * F.col("avail")).cast("long")
    even = F.floor(F.col("avail") / F.col("__m")) + (F.col("__i") <= F.col("avail") % F.col("__m")).cast("long")
    rows = rows.withColumn("__w", F.when(F.col("__tot") > 0, share).otherwise(even))
    ends = F.when((F.col("__tot") > 0) & (F.col("__i") == F.col("__m")), F.col("avail")).otherwise(F.least(F.sum("__w").over(so_far), F.col("avail")))
    rows = rows.withColumn("last", ends.cast("long")).withColumn("first", F.coalesce(F.lag("last").over(order), F.lit(0)) + 1)
    return rows.withColumn("n", F.col("last") - F.col("first") + 1).drop("__tot", "__m", "__i", "__w")


def split_pool(pool: DataFrame, requests: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Give every item of a pool its sample, in the pool's order, by the shares of ``allocate``.

    Sources that nobody asked for are spread evenly over all samples that are
    known. by: the keys of separate pools (a source, or none for one pool).
    """
    keys = by or ["__all"]
    if not by:
        pool, requests = pool.withColumn("__all", F.lit(0)), requests.withColumn("__all", F.lit(0))
    sizes = pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("avail"))
    samples = requests.groupBy("sample").agg(F.min("pos").alias("pos"))
    # the list of samples goes to every source as one array; Spark decides by its size how
    listed = samples.agg(F.collect_list(F.struct("sample", "pos")).alias("s"))
    grid = sizes.select(*keys).join(listed, F.lit(True)).select(*keys, F.inline("s"))
    asked = requests.groupBy(*keys, "sample").agg(F.sum("req").alias("req"))
    full = grid.join(asked, [*keys, "sample"], "left").fillna(0, ["req"])
    shares = allocate(full, sizes, keys).where("n > 0").select(*keys, "sample", "first", "last")
    numbered = running_sum(pool, keys, order, name="__before")
    dealt = numbered.join(shares, keys).where((F.col("__before") >= F.col("first") - 1) & (F.col("__before") < F.col("last")))
    return dealt.drop("__before", "first", "last", "__all")


def read_plan(abundance: DataFrame, genomes: DataFrame, n_reads: int, most: int | None = None) -> DataFrame:
    """Reads to make: annotator, sample, source, n, for labels with a genome, scaled per sample.

    With ``most``, only the labels with the largest totals stay.
    """
    usable = available_labels(abundance, genomes)
    if most:
        top = usable.groupBy("taxid").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "taxid").limit(most)
        usable = usable.join(top.select("taxid"), "taxid", "left_semi")
    scaled = scale_amounts(usable, n_reads, ["annotator", "sample"])
    return scaled.select("annotator", "sample", F.col("taxid").alias("source"), F.col("amount").alias("n")).where("n > 0")


def plan_totals(plan: DataFrame) -> DataFrame:
    """Reads to make of each source, over all samples of an annotator."""
    return plan.groupBy("annotator", "source").agg(F.sum("n").alias("n"))


def sample_design(spark, n_samples: int, total: int, genomes: DataFrame, host_share: float | None = None, seed: int = 42) -> DataFrame:
    """sample, source, n: host reads (a fixed or drawn share) and the rest spread evenly over genomes."""
    lot = F.conv(F.substring(F.md5(F.concat_ws("/", F.col("i").cast("string"), F.lit(str(seed)))), 1, 12), 16, 10).cast("long")
    drawn = F.pmod(lot, F.lit(total + 1)) if host_share is None else F.lit(int(total * host_share))
    samples = spark.range(1, n_samples + 1).select(F.col("id").alias("i"), F.concat(F.lit("sample"), F.col("id").cast("string")).alias("sample")).withColumn("host", drawn.cast("long"))
    names = genomes.select("taxid").distinct().agg(F.sort_array(F.collect_list("taxid")).alias("names"))
    rest = F.lit(total) - F.col("host")
    # the genomes of a design are a short list: it goes to every sample as one array
    spread = samples.join(names, F.lit(True)).select("sample", "host", F.size("names").alias("m"), F.posexplode("names").alias("k", "taxid"))
    community = spread.select("sample", F.col("taxid").alias("source"), (F.floor(rest / F.col("m")) + (F.col("k") < rest % F.col("m")).cast("long")).alias("n"))
    return samples.select("sample", F.lit("host").alias("source"), F.col("host").alias("n")).unionByName(community)
