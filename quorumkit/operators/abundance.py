"""Label-by-sample abundance, its filters, scalings and pair statistics.

Abundance is long: annotator, sample, taxid, n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_votes(votes: DataFrame, keep_null: bool = True, null_text: str = "nan") -> DataFrame:
    """Votes per annotator, sample and label. Null labels count under ``null_text`` or are dropped."""
    rows = votes.select("annotator", "sample", F.coalesce("label", F.lit(null_text)).alias("taxid")) if keep_null else votes.where("label IS NOT NULL").select("annotator", "sample", F.col("label").alias("taxid"))
    return rows.groupBy("annotator", "sample", "taxid").agg(F.count(F.lit(1)).alias("n"))


def complete(abundance: DataFrame) -> DataFrame:
    """Zero rows for labels that a sample of the same annotator lacks; both lists are distinct keys."""
    taxa = abundance.select("annotator", "taxid").distinct()
    samples = abundance.select("annotator", "sample").distinct()
    grid = taxa.join(samples, "annotator")
    return grid.join(abundance, ["annotator", "sample", "taxid"], "left").select("annotator", "sample", "taxid", F.coalesce("n", F.lit(0)).alias("n"))


def _total() -> Column:
    return F.sum("n").over(Window.partitionBy("annotator", "sample"))


def rescale_plain(abundance: DataFrame, n_reads: int) -> DataFrame:
    """Counts scaled so that each sample has about ``n_reads``, rounded half to even; residuals stay."""
    return abundance.withColumn("n", F.when(_total() > 0, F.bround(F.col("n") / _total() * F.lit(float(n_reads)))).otherwise(F.col("n")).cast("long"))


def scale_exact(abundance: DataFrame, n_reads: int | None) -> DataFrame:
    """As above, but the residual goes to the sample's largest label (the first of equals); empty samples stay."""
    if not n_reads:
        return abundance.withColumn("n", F.bround(F.col("n").cast("double")).cast("long"))
    own = Window.partitionBy("annotator", "sample")
    scaled = abundance.withColumn("__t", _total()).withColumn("__s", F.when(F.col("__t") > 0, F.bround(F.col("n") / F.col("__t") * F.lit(float(n_reads)))).otherwise(F.col("n")).cast("long"))
    scaled = scaled.withColumn("__r", F.row_number().over(own.orderBy(F.desc("__s"), "taxid"))).withColumn("__a", F.sum("__s").over(own))
    extra = F.when((F.col("__r") == 1) & (F.col("__t") > 0) & (F.col("__a") > 0), n_reads - F.col("__a")).otherwise(0)
    return scaled.withColumn("n", (F.col("__s") + extra).cast("long")).select(*abundance.columns)


def filter_labels(abundance: DataFrame, threshold: float, n_reads: int | None = None, rescale: bool = False) -> DataFrame:
    """Keep labels whose largest share of any sample reaches the threshold.

    If none does, an annotator keeps all labels that are not zero. With rescale
    the counts are scaled first and that fallback does not apply.
    """
    label, annotator = Window.partitionBy("annotator", "taxid"), Window.partitionBy("annotator")
    share = F.when(_total() > 0, F.col("n") / _total()).otherwise(0.0)
    if rescale and n_reads and n_reads > 0:
        scaled = abundance.withColumn("n", share * F.lit(float(n_reads)))
        if threshold <= 0:
            return scaled
        return scaled.withColumn("__m", F.max("n").over(label)).where(F.col("__m") >= threshold * n_reads).drop("__m")
    if threshold <= 0:
        return abundance
    marked = abundance.withColumn("__f", share).withColumn("__k", F.max("__f").over(label) >= threshold)
    marked = marked.withColumn("__any", F.max("__k").over(annotator)).withColumn("__m", F.max("n").over(label))
    return marked.where(F.col("__k") | (~F.col("__any") & (F.col("__m") > 0))).select(*abundance.columns)


def drop_zero_labels(abundance: DataFrame) -> DataFrame:
    by = Window.partitionBy("annotator", "taxid")
    return abundance.withColumn("__t", F.sum("n").over(by)).where("__t > 0").drop("__t")


def merge_tables(abundance: DataFrame, annotators: list[str], keys: tuple[str, ...] = ("sample", "taxid")) -> DataFrame:
    """Count tables of all annotators side by side; a label that one lacks has 0 there."""
    wide = abundance.groupBy(*keys).pivot("annotator", annotators).sum("n").fillna(0)
    return wide.select(*keys, *(F.col(f"`{a}`").alias(f"N_{a}") for a in annotators))


def sum_labels(abundance: DataFrame) -> DataFrame:
    """Rows of equal annotator, sample and label as one."""
    return abundance.groupBy("annotator", "sample", "taxid").agg(F.sum("n").alias("n"))


def label_totals(abundance: DataFrame) -> DataFrame:
    return abundance.groupBy("taxid").agg(F.sum("n").alias("n"))


def available_labels(abundance: DataFrame, genomes: DataFrame) -> DataFrame:
    """Rows whose label has a genome."""
    return abundance.join(genomes.select("taxid").distinct(), "taxid", "left_semi")


def top_available(abundance: DataFrame, genomes: DataFrame, most: int) -> DataFrame:
    """The ``most`` labels with the largest totals among those with a genome."""
    return label_totals(available_labels(abundance, genomes)).orderBy(F.desc("n"), "taxid").limit(most)


def scale_amounts(amounts: DataFrame, target: int, by: list[str]) -> DataFrame:
    """floor(n / total * target) within groups; negative amounts count as 0."""
    n = F.greatest(F.col("n"), F.lit(0))
    total = F.sum(n).over(Window.partitionBy(*by))
    return amounts.withColumn("amount", F.when(total > 0, F.floor(n / total * F.lit(target))).otherwise(0).cast("long"))


def observed_samples(votes: DataFrame, n_samples: int | None = None) -> int:
    """n_samples, or where that is not positive the number of distinct samples, at least 1."""
    if n_samples and n_samples > 0:
        return int(n_samples)
    return max(1, votes.select(F.countDistinct("sample")).first()[0])


def sample_number(votes: DataFrame, n_samples: int | None = None) -> DataFrame:
    """One row with the same number as a table (n)."""
    asked = int(n_samples) if n_samples and n_samples > 0 else 0
    return votes.agg(F.when(F.lit(asked > 0), F.lit(asked).cast("long")).otherwise(F.greatest(F.countDistinct("sample"), F.lit(1))).alias("n"))


def label_pairs(abundance: DataFrame) -> DataFrame:
    """annotator, a, b, x, y, sample for all ordered pairs of labels, with zeros filled in.

    The square of the labels that a filter kept, which is why one comes first.
    """
    full = complete(abundance)
    x = full.select("annotator", "sample", F.col("taxid").alias("a"), F.col("n").alias("x"))
    y = full.select("annotator", "sample", F.col("taxid").alias("b"), F.col("n").alias("y"))
    return x.join(y, ["annotator", "sample"]).where("a <> b")


def pair_statistics(abundance: DataFrame) -> DataFrame:
    """For each ordered pair: P(b present | a present), the fit of y on x over shared samples, correlation.

    No shared sample: a zero model. One: the ratio x / y as slope. Else least
    squares. R2 is at least 1e-5. The correlation is of log1p counts, 0 where
    undefined and 1 where there is one sample only.
    """
    both = (F.col("x") > 0) & (F.col("y") > 0)
    on = lambda c: F.when(both, F.col(c).cast("double"))
    n = F.sum(both.cast("long"))
    raw = label_pairs(abundance).groupBy("annotator", "a", "b").agg(
        F.try_divide(n.cast("double"), F.sum((F.col("x") > 0).cast("long")).cast("double")).alias("prob"),
        n.alias("n_shared"),
        F.count(F.lit(1)).alias("n_samples"),
        F.regr_slope(on("y"), on("x")).alias("s"),
        F.regr_intercept(on("y"), on("x")).alias("i"),
        F.regr_r2(on("y"), on("x")).alias("r"),
        F.max(on("x")).alias("x1"),
        F.max(on("y")).alias("y1"),
        F.avg(on("y")).alias("my"),
        F.corr(F.log1p("x"), F.log1p("y")).alias("c"),
    )
    flat = F.col("my") / (1 + F.col("x1") * F.col("x1"))  # where x is constant: the fit with the least coefficients
    one, none = F.col("n_shared") == 1, F.col("n_shared") == 0
    return raw.select(
        "annotator",
        "a",
        "b",
        F.coalesce("prob", F.lit(0.0)).alias("prob"),
        "n_shared",
        F.when(none, 0.0).when(one, F.col("x1") / F.col("y1")).otherwise(F.coalesce("s", F.col("x1") * flat)).alias("slope"),
        F.when(none | one, 0.0).otherwise(F.coalesce("i", flat)).alias("intercept"),
        F.when(none | one, 1e-5).otherwise(F.greatest(F.coalesce("r", F.lit(0.0)), F.lit(1e-5))).alias("r2"),
        F.when(F.col("n_samples") < 2, 1.0).otherwise(F.coalesce(F.nanvl("c", F.lit(0.0)), F.lit(0.0))).alias("corr"),
    )
