"""Multi-class AdaBoost over decision stumps (SAMME) as stages of Spark ML.

Features are cut into bins once, and rows with the same bins and label become
one row with a weight. A round is one grouped histogram (feature, bin, label)
of weights, from which the best split of all features follows by running sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.sinks.shared import materialize

#: Rounds between two writes of the rows' weights; in between they are a formula of the last rounds' stumps.
CUT_EVERY = 10


def cells_of(rows: DataFrame, features: str, label: str, weight: str | None = None) -> DataFrame:
    """(features, label, n): rows with equal features and label as one, written once, since every step of learning reads them; ``weight`` says how many rows a row stands for."""
    n = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    each = rows.select(vector_to_array(features).alias("features"), F.col(label).cast("double").alias("label"), n.alias("n")).where("label IS NOT NULL")
    cells = materialize(each.groupBy("features", "label").agg(F.sum("n").alias("n")))
    return cells.select(array_to_vector("features").alias("features"), "label", "n")


def bin_limits(rows: DataFrame, features: str, most: int, all_rows: DataFrame | None = None) -> list[list[float]]:
    """For each feature the limits between its bins: midpoints of its values, or of ``most`` quantiles where it has more of them.

    Where ``rows`` are cells, ``all_rows`` are what they stand for; only quantiles ask for them.
    """
    pick = lambda df: df.select(F.posexplode(vector_to_array(features)).alias("feature", "v"))
    values = materialize(pick(rows).distinct())
    sizes = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each feature
    large = [i for i, n in sizes.items() if n > most]
    each = values.where(~F.col("feature").isin(large)).groupBy("feature").agg(F.sort_array(F.collect_list("v")).alias("v"))  # at most ``most`` values
    if large:
        quantiles = F.percentile_approx("v", F.array(*(F.lit(i / most) for i in range(most + 1))), 10_000)
        many = pick(rows if all_rows is None else all_rows).where(F.col("feature").isin(large))
        each = each.unionByName(many.groupBy("feature").agg(F.sort_array(F.array_distinct(quantiles)).alias("v")))
    found = {r["feature"]: np.array(r["v"]) for r in each.collect()}
    return [((found[i][1:] + found[i][:-1]) / 2).tolist() for i in range(len(found))]


def bins_of(features: Column, limits: list[list[float]]) -> Column:
    """The bin of each feature: how many of its limits lie below its value."""

    @F.arrow_udf("array<int>")
    def run(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(limits))
        out = np.stack([np.searchsorted(np.array(at), x[:, i]) for i, at in enumerate(limits)], axis=1) if len(rows) else x
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(limits), pa.int32()), pa.array(out.ravel().astype(np.int32)))

    return run(features)


def weight_histogram(rows: DataFrame) -> DataFrame:
    """feature, bin, label and the sum of the weights w; rows have bins, label and w."""
    return rows.select(F.posexplode("bins").alias("feature", "bin"), "label", "w").groupBy("feature", "bin", "label").agg(F.sum("w").alias("w"))


def stump_choices(histogram: DataFrame) -> DataFrame:
    """Every split of every feature: feature, bin (the last on the left side), impurity, left and right label, and the weight that these hit.

    Impurity is the weighted Gini sum of both sides, rounded to nine digits.
    A side's label is its heaviest, of equal ones the smallest; splits with an
    empty side are left out.
    """
    bins = histogram.select("feature", "bin").distinct()
    seen = histogram.select("feature", "label").distinct()  # a label that a feature never meets has no part in its sums
    full = bins.join(seen, "feature").join(histogram, ["feature", "bin", "label"], "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    by = Window.partitionBy("feature", "label")
    sides = full.select("feature", "bin", "label", F.sum("w").over(by.orderBy("bin")).alias("a"), F.sum("w").over(by).alias("t")).withColumn("b", F.col("t") - F.col("a"))
    heavy = lambda c: F.max(F.struct(F.round(c, 9).alias("r"), (-F.col("label")).alias("label"), F.col(c).alias("w")))
    each = sides.groupBy("feature", "bin").agg(F.sum("a").alias("left"), F.sum("b").alias("right"), F.sum(F.col("a") * F.col("a")).alias("a2"), F.sum(F.col("b") * F.col("b")).alias("b2"), heavy("a").alias("best_a"), heavy("b").alias("best_b"))
    impurity = F.col("left") - F.col("a2") / F.col("left") + F.col("right") - F.col("b2") / F.col("right")
    some = each.where("left > 1e-12 AND right > 1e-12")
    return some.select("feature", "bin", F.round(impurity, 9).alias("impurity"), (-F.col("best_a.label")).alias("left_label"), (-F.col("best_b.label")).alias("right_label"), (F.col("best_a.w") + F.col("best_b.w")).alias("hit"))


def _feature_best(table: pa.Table) -> pa.Table:
    """The first choice of least impurity of one feature, as ``stump_choices`` has it, from its bins x labels."""
    bins, row = np.unique(table.column("bin").to_numpy(), return_inverse=True)
    labels, column = np.unique(table.column("label").to_numpy(), return_inverse=True)
    w = np.zeros((len(bins), len(labels)))
    w[row, column] = table.column("w").to_numpy()
    a = np.cumsum(w, axis=0)
    b = a[-1] - a
    left, right = a.sum(1), b.sum(1)
    use = np.flatnonzero((left > 1e-12) & (right > 1e-12))
    a, b, left, right = a[use], b[use], left[use], right[use]
    impurity = np.round(left - (a * a).sum(1) / left + right - (b * b).sum(1) / right, 9)
    best = np.argmin(impurity) if len(use) else slice(0)
    at = np.atleast_1d(np.arange(len(use))[best])
    one, two = (np.argmax(np.round(side[at], 9), axis=1) if len(at) else at for side in (a, b))  # the first, so the smallest label
    hit = a[at, one] + b[at, two]
    feature = table.column("feature").slice(0, len(at)).cast(pa.int32())
    return pa.table([feature, pa.array(bins[use][at].astype(np.int32)), pa.array(impurity[at]), pa.array(labels[one]), pa.array(labels[two]), pa.array(hit)], names=["feature", "bin", "impurity", "left_label", "right_label", "hit"])


def best_stump(histogram: DataFrame) -> DataFrame:
    """The choice of least impurity; of equal ones the first feature, then the first bin. No row if no feature can be split."""
    each = histogram.groupBy("feature").applyInArrow(_feature_best, "feature int, bin int, impurity double, left_label double, right_label double, hit double")
    return each.orderBy("impurity", "feature", "bin").limit(1)


class _Stump:
    """One weak learner; its sides are the labels for bins up to ``bin`` and beyond."""

    def __init__(self, feature: int, bin: int, limit: float, left: float, right: float, alpha: float):
        self.feature, self.bin, self.limit, self.left, self.right, self.alpha = feature, bin, limit, left, right, alpha

    def missed(self) -> Column:
        said = F.when(F.col("bins")[self.feature] <= self.bin, self.left).otherwise(self.right)
        return said != F.col("label")

    def plain(self) -> list:
        return [self.feature, self.bin, self.limit, self.left, self.right, self.alpha]


class _BoosterParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol):
    rounds = Param(Params._dummy(), "rounds", "rounds of boosting", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature with more values than that", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(rounds=100, maxBins=256, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability")


class StumpBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """SAMME: each round takes the stump of least Gini impurity under the weights and raises the weight of the rows that it misses.

    Ends when a stump misses nothing or is no better than guessing. Labels are
    numbers from 0; weights say how many rows a row stands for. No rows give a
    model without stumps, which says 0.
    """

    @keyword_only
    def __init__(self, *, rounds=100, maxBins=256, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", weightCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "StumpBoosterModel":
        features, label = self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double")
        weight = self.getWeightCol() if self.isDefined("weightCol") else None
        rows = dataset.select(F.col(features).alias("features"), label.alias("label"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("n")).where("label IS NOT NULL")
        cells = cells_of(rows, "features", "label", "n")
        top, n = cells.agg(F.max("label"), F.sum("n")).first()
        classes = 1 if top is None else int(top) + 1
        model = self._copyValues(StumpBoosterModel([], classes))
        if top is None:
            return model
        each = rows if weight is None else rows.select("features", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        limits = bin_limits(cells, "features", self.getOrDefault(self.maxBins), each)
        work = cells.select(bins_of(vector_to_array("features"), limits).alias("bins"), "label", "n").groupBy("bins", "label").agg(F.sum("n").cast("double").alias("w"))
        work = materialize(work.withColumn("w", F.col("w") / n))
        stumps: list[_Stump] = []
        written = 0
        for _ in range(self.getOrDefault(self.rounds)):
            recent = stumps[written:]
            if len(recent) == CUT_EVERY:
                work, written, recent = materialize(work.withColumn("w", self._raised(recent))), len(stumps), []
            now = work.withColumn("w", self._raised(recent))
            found = best_stump(weight_histogram(now)).first()
            if found is None:
                break
            error = max(0.0, 1 - found["hit"])
            if error >= 1 - 1 / classes:
                break
            alpha = math.log((1 - max(error, 1e-10)) / max(error, 1e-10)) + math.log(max(classes - 1, 1))
            at = limits[found["feature"]][found["bin"]]
            stumps.append(_Stump(found["feature"], found["bin"], at, found["left_label"], found["right_label"], alpha))
            stumps[-1].total = 1 - error + error * math.exp(alpha)  # what all weights sum to, after this round's raise
            if error <= 1e-12:
                break
        model.stumps = [s.plain() for s in stumps]
        return model

    @staticmethod
    def _raised(stumps: Sequence[_Stump]) -> Column:
        out = F.col("w")
        for s in stumps:
            out = out * F.when(s.missed(), math.exp(s.alpha)).otherwise(1.0) / s.total
        return out


class _Writer(MLWriter):
    def __init__(self, model: "StumpBoosterModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"stumps": self.model.stumps, "classes": self.model.classes})


class _Reader(MLReader):
    def load(self, path: str) -> "StumpBoosterModel":
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = StumpBoosterModel(facts["stumps"], facts["classes"])
        model._resetUid(facts["uid"])
        DefaultParamsReader.getAndSetParams(model, facts)
        return model


class StumpBoosterModel(Model, _BoosterParams, MLWritable, MLReadable):
    """Sums of the stumps' weights for each class, normalised, as ``probability``; the first of the largest is the prediction."""

    def __init__(self, stumps: list[list] | None = None, classes: int = 1):
        super().__init__()
        self.stumps, self.classes = stumps or [], classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stumps, classes = self.stumps, self.classes

        @F.arrow_udf("array<double>")
        def shares(rows: pa.Array) -> pa.Array:
            lists = rows.to_pylist()
            x = np.array(lists, float).reshape(len(lists), -1)
            scores = np.zeros((len(lists), classes))
            for feature, _, limit, left, right, alpha in stumps:
                scores[np.arange(len(lists)), np.where(x[:, feature] <= limit, int(left), int(right))] += alpha
            total = scores.sum(1, keepdims=True)
            scores = np.divide(scores, total, out=scores, where=total > 0)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * classes, pa.int32()), pa.array(scores.ravel()))

        out = dataset.withColumn("__shares", shares(vector_to_array(self.getFeaturesCol())))
        best = (F.array_position("__shares", F.array_max("__shares")) - 1).cast("double")
        return out.withColumn(self.getPredictionCol(), best).withColumn(self.getProbabilityCol(), array_to_vector("__shares")).drop("__shares")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()
