"""Scores of annotators against truth and against each other.

Votes are long: sample, seq, true, annotator, label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.functions.labels import is_special
from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize


def collapse_other(votes: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """Labels outside the true labels and '0' become 'other'."""
    allowed = (votes if truth is None else truth).select(F.col("true").alias("label")).distinct().withColumn("__in", F.lit(True))
    joined = votes.join(allowed, "label", "left")
    return joined.withColumn("label", F.when(F.col("__in") | (F.col("label") == "0"), F.col("label")).otherwise("other")).select(*votes.columns)


def confusion(votes: DataFrame) -> DataFrame:
    """annotator, true, pred, freq."""
    return votes.groupBy("annotator", "true", F.col("label").alias("pred")).agg(F.count(F.lit(1)).alias("freq"))


def f1_scores(counts: DataFrame) -> DataFrame:
    """f1 as the share of the diagonal: precision and recall have one denominator here."""
    hit = F.sum(F.when(F.col("true") == F.col("pred"), F.col("freq")).otherwise(0))
    return counts.groupBy("annotator").agg((hit / F.sum("freq")).alias("f1"), F.sum("freq").alias("n"))


def macro_f1(counts: DataFrame) -> DataFrame:
    """Mean over true labels of 2 * hits / (true + predicted), the usual macro F1."""
    by_true = counts.groupBy("annotator", F.col("true").alias("label")).agg(F.sum("freq").alias("t"), F.sum(F.when(F.col("true") == F.col("pred"), F.col("freq")).otherwise(0)).alias("h"))
    by_pred = counts.groupBy("annotator", F.col("pred").alias("label")).agg(F.sum("freq").alias("p"))
    each = by_true.join(by_pred, ["annotator", "label"], "left")
    return each.groupBy("annotator").agg(F.avg(2 * F.col("h") / (F.col("t") + F.coalesce("p", F.lit(0)))).alias("macro_f1"))


def r2_scores(counts: DataFrame) -> DataFrame:
    """R2 of predicted against true totals over true labels; null without predictions, 0 without variance."""
    true = counts.groupBy("annotator", F.col("true").alias("label")).agg(F.sum("freq").alias("t"))
    pred = counts.groupBy("annotator", F.col("pred").alias("label")).agg(F.sum("freq").alias("p"))
    both = true.join(pred, ["annotator", "label"], "left").fillna(0, ["p"])
    by = Window.partitionBy("annotator")
    each = both.withColumn("mean", F.avg("t").over(by))
    sums = each.groupBy("annotator").agg(F.sum((F.col("t") - F.col("p")) ** 2).alias("res"), F.sum((F.col("t") - F.col("mean")) ** 2).alias("tot"), F.sum("p").alias("p"))
    return sums.select("annotator", F.when(F.col("p") <= 0, F.lit(None)).when(F.col("tot") == 0, 0.0).otherwise(1 - F.col("res") / F.col("tot")).alias("r2"))


def cross_validation(votes: DataFrame) -> DataFrame:
    """annotator_a, annotator_b, a, b, freq of every unordered pair of annotators.

    Votes of one read meet in one shuffle. Reads with the same votes are counted
    once and only then taken apart into pairs.
    """
    known = votes.where("sample IS NOT NULL AND seq IS NOT NULL AND annotator IS NOT NULL")
    return _pairs_of_votes(known.select("sample", "seq", F.array(F.struct("annotator", "label")).alias("v")))


def cross_validation_of_reads(wide: DataFrame, annotators: Sequence[str]) -> DataFrame:
    """``cross_validation`` of a table with a row for each read and a column for each annotator: a read is one row of the shuffle, however many annotators there are."""
    known = wide.where("sample IS NOT NULL AND seq IS NOT NULL")
    return _pairs_of_votes(known.select("sample", "seq", F.array(*(F.struct(F.lit(a).alias("annotator"), F.col(f"`{a}`").alias("label")) for a in annotators)).alias("v")))


def _pairs_of_votes(rows: DataFrame) -> DataFrame:
    """Pairs from (sample, seq, v), where v holds votes of a read; rows of one read are taken together."""
    reads = rows.repartition("sample", "seq").groupBy("sample", "seq").agg(F.array_sort(F.flatten(F.collect_list("v"))).alias("v"))
    kinds = reads.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    first = kinds.select("v", "n", F.explode("v").alias("x"))
    both = first.select("x", "n", F.explode("v").alias("y")).where("x.annotator < y.annotator")
    return both.groupBy(F.col("x.annotator").alias("annotator_a"), F.col("y.annotator").alias("annotator_b"), F.col("x.label").alias("a"), F.col("y.label").alias("b")).agg(F.sum("n").alias("freq"))


def top_labels(pairs: DataFrame, show_top: int) -> DataFrame:
    """The max(1, show_top - 1) most frequent labels of both sides of each pair; 0 keeps all."""
    both = pairs.select("annotator_a", "annotator_b", F.col("a").alias("label"), "freq").unionByName(pairs.select("annotator_a", "annotator_b", F.col("b").alias("label"), "freq"))
    sums = both.where(~is_special(F.col("label"))).groupBy("annotator_a", "annotator_b", "label").agg(F.sum("freq").alias("total"))
    by = Window.partitionBy("annotator_a", "annotator_b").orderBy(F.desc("total"), "label")
    ranked = sums.withColumn("place", F.row_number().over(by))
    return ranked.where(F.col("place") <= max(1, show_top - 1)) if show_top else ranked


def collapse_top(pairs: DataFrame, show_top: int) -> DataFrame:
    """Pair table in which labels outside the top and '0' are 'other'."""
    keep = top_labels(pairs, show_top).select("annotator_a", "annotator_b", "label")
    out = pairs
    for side in ("a", "b"):
        k = keep.select("annotator_a", "annotator_b", F.col("label").alias(side)).withColumn(f"in_{side}", F.lit(True))
        out = out.join(k, ["annotator_a", "annotator_b", side], "left")
        out = out.withColumn(side, F.when(F.col(f"in_{side}") | (F.col(side) == "0"), F.col(side)).otherwise("other")).drop(f"in_{side}")
    return out.groupBy("annotator_a", "annotator_b", "a", "b").agg(F.sum("freq").alias("freq"))


def pivot_matrix(pairs: DataFrame, row: str, column: str, levels: list[str]) -> DataFrame:
    """Contingency table with one column for each level, zero where nothing was counted."""
    return pairs.groupBy(row).pivot(column, levels).sum("freq").fillna(0)


def keep_labels(pairs: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """Rows whose labels, in all the given columns, are among those of a report (label)."""
    for c in columns:
        pairs = pairs.join(labels.select(F.col("label").alias(c)).distinct(), c, "left_semi")
    return pairs


def trim_matrix(pairs: DataFrame, row: str, column: str, most: int = 40) -> DataFrame:
    """Entries of the ``most`` largest rows and columns; '0' and 'other' come after the others."""
    out = pairs
    for side in (row, column):
        totals = pairs.groupBy(side).agg(F.sum("freq").alias("__t"))
        kept = totals.orderBy(F.col(side).isin("0", "other"), F.desc("__t"), side).limit(most).select(side)
        out = out.join(kept, side, "left_semi")
    return out


def correctness_counts(wide: DataFrame, annotators: list[str]) -> DataFrame:
    """How many reads have each combination of right and wrong votes."""
    flags = wide.select(*(F.coalesce(F.col(f"`{a}`") == F.col("true"), F.lit(False)).alias(a) for a in annotators))
    return flags.groupBy(*annotators).agg(F.count(F.lit(1)).alias("n"))


def truth_counts(wide: DataFrame) -> DataFrame:
    return wide.groupBy("true").agg(F.count(F.lit(1)).alias("n"))


def confidence_summary(scored: DataFrame, label: str, confidence: str, show_top: int = 10, shares: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Box-plot values (low, q1, median, q3, high) of the confidence for the most frequent labels; 0 shows all.

    Exact, between neighbours linearly. A label's rows are numbered in order of
    their confidence over range partitions, so a label of any size is spread
    over many tasks and no buffer holds its values. Rows without a confidence
    count in n and nowhere else; a label that has none gets nulls.
    """
    rows = scored.select(F.col(label).alias("label"), F.col(confidence).cast("double").alias("v"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("m"))
    top = materialize(counts.orderBy(F.desc("n"), "label").limit(show_top) if show_top else counts)
    known = top.select(F.col("label").alias("__label"), "m")
    same = F.col("label").eqNullSafe(F.col("__label"))
    ranked = running_sum(rows.where("v IS NOT NULL").join(known.drop("m"), same, "left_semi"), ["label"], ["v"], name="at").join(known, same)
    names = ("low", "q1", "median", "q3", "high")
    place = [(F.col("m") - 1) * F.lit(float(p)) for p in shares]
    values = [(F.max(F.when(F.col("at") == F.floor(h), F.col("v"))), F.max(F.when(F.col("at") == F.ceil(h), F.col("v"))), F.max(h - F.floor(h))) for h in place]
    found = ranked.groupBy("__label").agg(*((a + (b - a) * w).alias(c) for c, (a, b, w) in zip(names, values)))
    out = top.join(found, F.col("label").eqNullSafe(F.col("__label")), "left").select("label", "n", *names)
    return out.orderBy(F.desc("n"), "label") if show_top else out


#: Labels up to which the whole matrix (128 KB) is solved at once; more take the distributed way to the same axis.
SMALL_MATRIX = 128
#: Steps of the distributed way at most, and the residual at which it ends.
MOST_STEPS, RESIDUAL = 300, 1e-9


def _principal_axis(cells: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """(label, score) along the first principal axis of a symmetric sparse matrix (x, y, f), columns centred implicitly.

    Lanczos steps on the product of the centred matrix with itself: a step is
    two joins of the cells with a vector; vectors stay tables, only their inner
    products come to the driver.
    """
    sums = cells.groupBy(F.col("x").alias("label")).agg(F.sum("f").alias("t"))
    start = F.pmod(F.xxhash64("label"), F.lit(1 << 20)) / float(1 << 20) - 0.5
    basis = materialize(labels.join(sums, "label", "left").select("label", (F.coalesce("t", F.lit(0.0)) / n).alias("mean"), F.array(start).alias("q")))

    def times(vector: DataFrame) -> DataFrame:
        product = cells.join(vector.select(F.col("label").alias("y"), "v"), "y").groupBy(F.col("x").alias("label")).agg(F.sum(F.col("f") * F.col("v")).alias("p"))
        return basis.select("label", "mean").join(product, "label", "left").select("label", "mean", F.coalesce("p", F.lit(0.0)).alias("p"))

    def total(df: DataFrame, *values: Column) -> list[float]:
        return [float(v or 0) for v in df.agg(*(F.sum(v) for v in values)).first()]

    def centred(vector: DataFrame) -> DataFrame:
        """The centred matrix times a vector (label, mean, v)."""
        shift = total(vector, F.col("mean") * F.col("v"))[0]
        return times(vector).select("label", "mean", (F.col("p") - F.lit(shift)).alias("v"))

    norms = [math.sqrt(total(basis, F.col("q")[0] * F.col("q")[0])[0])]
    inner: list[list[float]] = []
    for step in range(min(n, MOST_STEPS)):
        now = basis.select("label", "mean", (F.col("q")[step] / norms[step]).alias("v"))
        half = materialize(centred(now))
        drift = total(half, F.col("v"))[0]
        moved = times(half).select("label", (F.col("p") - F.col("mean") * F.lit(drift)).alias("w"))
        joined = materialize(basis.join(moved, "label"))
        unit = [F.col("q")[i] / norms[i] for i in range(step + 1)]
        first = total(joined, *(F.col("w") * u for u in unit))
        rest = F.col("w") - sum((F.lit(c) * u for c, u in zip(first, unit)), F.lit(0.0))
        second = total(joined, *(rest * u for u in unit))  # once more, against what rounding left
        rest = rest - sum((F.lit(c) * u for c, u in zip(second, unit)), F.lit(0.0))
        basis = materialize(joined.select("label", "mean", F.array_append("q", rest).alias("q")))
        norms.append(math.sqrt(total(basis, F.col("q")[step + 1] * F.col("q")[step + 1])[0]))
        inner.append([a + b for a, b in zip(first, second)])
        matrix = np.zeros((step + 1, step + 1))
        for i, column in enumerate(inner):
            matrix[i, i] = column[i]
            if i:
                matrix[i, i - 1] = matrix[i - 1, i] = norms[i]
        value, vectors = np.linalg.eigh(matrix)
        best = vectors[:, -1]
        if norms[-1] * abs(best[-1]) <= RESIDUAL * max(value[-1], 1e-300):
            break
    axis = sum((F.lit(float(c)) * F.col("q")[i] / norms[i] for i, c in enumerate(best)), F.lit(0.0))
    return centred(basis.select("label", "mean", axis.alias("v"))).select("label", F.col("v").alias("score"))


def label_order(pairs: DataFrame) -> DataFrame:
    """(label, place): labels along the first principal axis of the symmetric confusion matrix, the diagonal counted once.

    The axis points to the label with the largest score in absolute terms.
    Without variance labels go by their totals; '0' and 'other' (and other special
    labels) come last; equal scores go by label. There is no limit on labels.
    """
    spark = pairs.sparkSession
    pairs = materialize(pairs.groupBy("a", "b").agg(F.sum("freq").alias("freq")))  # read several times; a row for each pair of labels
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("freq").cast("double").alias("f"))
    labels = materialize(both.select(F.col("x").alias("label")).unionByName(both.select(F.col("y").alias("label"))).where("label IS NOT NULL").distinct())
    core, special = labels.where(~is_special(F.col("label"))), labels.where(is_special(F.col("label")))
    mirrored = both.where("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "f")
    plain = ~is_special(F.col("x")) & ~is_special(F.col("y"))
    cells = materialize(both.unionByName(mirrored).where(plain).groupBy("x", "y").agg(F.sum("f").alias("f")))
    n = core.count()
    facts = cells.agg(F.count(F.lit(1)), F.coalesce(F.min("f"), F.lit(0.0)), F.coalesce(F.max("f"), F.lit(0.0))).first()
    flat = facts[1] == facts[2] and (facts[0] == n * n or facts[2] == 0)
    if n < 2 or flat:
        sums = cells.groupBy(F.col("x").alias("label")).agg((-F.sum("f")).alias("score"))
        scored = core.join(sums, "label", "left").select("label", F.coalesce("score", F.lit(0.0)).alias("score"))
    elif n <= SMALL_MATRIX:
        names = sorted(r["label"] for r in core.collect())  # at most SMALL_MATRIX
        at = {name: i for i, name in enumerate(names)}
        matrix = np.zeros((n, n))
        for x, y, f in cells.collect():
            matrix[at[x], at[y]] = f
        matrix -= matrix.mean(0)
        axis = np.linalg.svd(matrix)[2][0]
        scored = spark.createDataFrame([(name, float(v)) for name, v in zip(names, matrix @ axis)], "label string, score double")
    else:
        scored = _principal_axis(cells, core, n)
    scored = materialize(scored)
    sign = 1.0 if n < 2 or flat else math.copysign(1.0, scored.agg(F.max_by("score", F.struct(F.round(F.abs("score"), 6), "label"))).first()[0])
    every = scored.select("label", (F.col("score") * sign).alias("score"), F.lit(False).alias("last")).unionByName(special.select("label", F.lit(0.0).alias("score"), F.lit(True).alias("last")))
    return running_sum(every, [], ["last", "score", "label"], name="before").select("label", (F.col("before") + 1).cast("int").alias("place"))
