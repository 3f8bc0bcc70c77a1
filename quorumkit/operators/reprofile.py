"""The re-profiler: votes and features to one corrected label with a confidence."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumkit.functions.labels import all_unclassified, fill_votes, label_number, tool_name
from quorumkit.operators.boosting import StumpBooster, StumpBoosterModel
from quorumkit.operators.deep_forest import DeepForestModel, fit_forest
from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize
from quorumkit.sinks.tables import write_reprofiled
from quorumkit.sources.tables import read_pooled

TREES, ROUNDS, SEED, DEPTH = 100, 100, 42, 30


def feature_columns(columns: Sequence[str]) -> list[str]:
    """Predictors in sorted order; length always takes part."""
    return sorted({c for c in columns if c not in ("seq", "sample", "true")} | {"length"})


def stratified_split(rows: DataFrame, key: str = "seq", label: str = "true", test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: the hash-first share of each label, so the split does not depend on the partitions."""
    sizes = rows.groupBy(F.col(label).alias("__y")).agg(F.count(F.lit(1)).alias("__n"))
    placed = running_sum(rows.withColumn("__lot", F.xxhash64(key, F.lit(seed))), [label], ["__lot", key], name="__before")
    joined = placed.join(sizes, F.col(label).eqNullSafe(F.col("__y")))
    return joined.withColumn("is_test", F.col("__before") < F.floor(F.col("__n") * F.lit(test_share) + 0.5)).drop("__lot", "__before", "__y", "__n")


def assemble(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector; columns that are absent count as 0."""
    filled = rows.withColumns({c: F.lit(0.0) for c in features if c not in rows.columns})
    filled = filled.withColumns({c: (label_number(F.col(c)) if tool_name(c) else F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0))) for c in features})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def fit_boosted(rows: DataFrame, rounds: int = ROUNDS, weight: str | None = None) -> StumpBoosterModel:
    """SAMME over stumps; rows have features and label, and a weight if they stand for several."""
    return (StumpBooster(rounds=rounds, weightCol=weight) if weight else StumpBooster(rounds=rounds)).fit(rows)


@dataclass
class Reprofiler:
    """The better of the two models, with what is needed to apply it."""

    name: str
    model: object
    labels: StringIndexerModel
    features: list[str]
    accuracy: dict[str, float]

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds model_label and model_confidence (the largest class probability)."""
        out = self.model.transform(assemble(rows, self.features))
        out = IndexToString(inputCol="prediction", outputCol="model_label", labels=[*self.labels.labels, "0"]).transform(out)
        return out.withColumn("model_confidence", F.array_max(vector_to_array("probability"))).drop("features", "rawPrediction", "probability", "prediction", "indexed")


def train(rows: DataFrame, trees: int = TREES, rounds: int = ROUNDS, test_share: float = 0.2, seed: int = SEED, depth: int = DEPTH) -> Reprofiler | None:
    """Random forest and boosted stumps on votes and features; the more accurate one on the hold-out.

    A tie goes to the forest. No row with a truth gives None. Label columns are
    numbers; there are as many bins as the largest number of values of one of
    them, so different labels never fall into one bin. Both learn from cells:
    rows with equal features and label count as one with a weight.
    """
    features = feature_columns(rows.columns)
    used = [c for c in features if c in rows.columns]
    known = materialize(rows.where(F.col("true").isNotNull() & (F.col("true") != "")).select("seq", "true", *(F.col(f"`{c}`") for c in used)))
    split = stratified_split(known, test_share=test_share, seed=seed)
    cells = materialize(split.groupBy(*(F.col(f"`{c}`") for c in used), "true", "is_test").agg(F.count(F.lit(1)).alias("__rows")))
    if not cells.limit(1).count():
        return None
    labels = StringIndexer(inputCol="true", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep").fit(cells)
    ready = labels.transform(assemble(cells, features)).select("features", "label", "is_test", "__rows")
    fit, test = ready.where("NOT is_test"), ready.where("is_test")
    votes = [c for c in features if tool_name(c)]
    counts = cells.agg(*(F.countDistinct(F.col(f"`{c}`")) for c in votes)).first() if votes else []
    bins = max([32, *(int(c) + 1 for c in counts)])
    forest = fit_forest(fit, trees, depth, bins, seed, "__rows")
    boosted = StumpBooster(rounds=rounds, maxBins=bins, weightCol="__rows").fit(fit)
    accuracy = {}
    for name, m in (("RandomForest", forest), ("AdaBoost", boosted)):
        right = F.when(F.col("prediction") == F.col("label"), F.col("__rows")).otherwise(0)
        accuracy[name] = m.transform(test).agg(F.try_divide(F.sum(right), F.sum("__rows"))).first()[0] or 0.0
    best = "AdaBoost" if accuracy["AdaBoost"] > accuracy["RandomForest"] else "RandomForest"
    return Reprofiler(best, {"RandomForest": forest, "AdaBoost": boosted}[best], labels, features, accuracy)


def consensus(rows: DataFrame, annotators: Sequence[str], label: Column, confidence: Column) -> tuple[DataFrame, Column, Column]:
    """Unanimous non-zero votes override the model: confidence 1 if there are two or more.

    The rows come back with the number of each vote in a column of its own, so
    that a label is searched for digits once; the two results are over those.
    """
    names = [f"__vote{i}" for i in range(len(annotators))]
    numbered = rows.withColumns({n: F.nullif(label_number(F.col(f"`{a}`")).cast("long"), F.lit(0)) for n, a in zip(names, annotators)})
    # least and greatest skip nulls and want two columns
    both = [F.col(n) for n in names] + [F.lit(None).cast("long")] * 2
    low, high = F.least(*both), F.greatest(*both)
    cast = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    agreed = high.isNotNull() & (low == high)
    return numbered, F.when(agreed, high.cast("string")).otherwise(label), F.when(agreed & (cast >= 2), 1.0).otherwise(confidence)


def apply_reprofiler(rows: DataFrame, model: Reprofiler, drop_without_truth: bool = False) -> DataFrame:
    """Adds ``corrected`` and ``corrected_confidence``.

    Rows that no annotator classified get 0 and confidence 0. With
    drop_without_truth, rows whose truth is missing get 0 as well.
    """
    annotators = [c for c in rows.columns if tool_name(c)]
    scored, label, sure = consensus(model.score(rows), annotators, F.col("model_label"), F.col("model_confidence"))
    none = all_unclassified(annotators)
    if drop_without_truth and "true" in rows.columns:
        none = none | F.col("true").isNull() | (F.col("true") == "")
    return scored.select(*rows.columns, F.when(none, "0").otherwise(label).alias("corrected"), F.when(none, 0.0).otherwise(sure).alias("corrected_confidence"))


def roc_points(scored: DataFrame, probability: str = "probability", label: str = "label") -> DataFrame:
    """(score, label) of each row and class: one-hot truth against class probabilities."""
    return scored.select(F.col(label).alias("__y"), F.posexplode(vector_to_array(probability)).alias("k", "score")).select("score", (F.col("k") == F.col("__y")).cast("double").alias("label"))


def auc_table(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., auc, positives, negatives): the exact area under the ROC curve of (score, label) points.

    The share of pairs in which the positive has the larger score, equal scores
    counting half: midranks, from running sums over range partitions of the
    distinct scores. Null without a point of either kind.
    """
    keys = list(keys)
    cells = points.groupBy(*keys, "score").agg(F.sum("label").cast("long").alias("p"), F.sum(1 - F.col("label")).cast("long").alias("n"))
    below = running_sum(cells, keys, ["score"], F.col("n"), "below")
    won = F.sum(F.col("p") * (F.col("below") + F.col("n") / 2))
    positives, negatives = F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    return below.groupBy(*keys).agg(F.try_divide(won, positives.cast("double") * negatives).alias("auc"), positives.alias("positives"), negatives.alias("negatives"))


def micro_auc(points: DataFrame) -> float:
    return auc_table(points).first()["auc"]


def roc_curve(points: DataFrame) -> DataFrame:
    """(score, fpr, tpr) at every distinct score: the shares of negatives and positives with that score or more."""
    cells = points.groupBy("score").agg(F.sum("label").cast("long").alias("p"), F.sum(1 - F.col("label")).cast("long").alias("n"))
    above = running_sum(running_sum(cells, [], [F.desc("score")], F.col("p"), "p_above"), [], [F.desc("score")], F.col("n"), "n_above")
    p, n = cells.agg(F.sum("p"), F.sum("n")).first()
    share = lambda x, all_of: (F.try_divide(F.col(f"{x}_above") + F.col(x), F.lit(all_of).cast("double")))
    return above.select("score", share("n", n).alias("fpr"), share("p", p).alias("tpr"))


def reprofile(votes: DataFrame, training: DataFrame, features: DataFrame | None = None, **settings) -> DataFrame | None:
    """Train on a labelled vote table and apply to another; None if nothing can be learnt."""
    from quorumkit.operators.combine import join_features

    model = train(join_features(training, features), **settings)
    return None if model is None else apply_reprofiler(join_features(votes, features), model)


def reprofile_directory(spark: SparkSession, votes: Sequence[str], training: Sequence[str], out: str, features: DataFrame | None = None, **settings) -> DataFrame | None:
    """Re-profile the per-sample vote files ``votes`` and write <sample>_reprofiled folders below ``out``.

    Missing votes count as 0 (a missing truth never does). Without files, or
    without rows to learn from, nothing is written and None comes back.
    """
    pooled, known = read_pooled(spark, list(votes)), read_pooled(spark, list(training))
    if pooled is None or known is None or "true" not in known.columns:
        return None
    scored = reprofile(fill_votes(pooled), fill_votes(known), features, **settings)
    if scored is not None:
        write_reprofiled(scored, out)
    return scored


def save_model(model: Reprofiler, path: str) -> None:
    """Write a re-profiler of either kind to a folder."""
    spark = SparkSession.active()
    facts = {"name": model.name, "features": model.features, "accuracy": model.accuracy}
    model.model.write().overwrite().save(f"{path}/model")
    model.labels.write().overwrite().save(f"{path}/labels")
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_model(spark: SparkSession, path: str) -> Reprofiler:
    """A saved re-profiler, ready for ``apply_reprofiler``."""
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    kind = StumpBoosterModel if facts["name"] == "AdaBoost" else DeepForestModel
    model = kind.load(f"{path}/model")
    return Reprofiler(facts["name"], model, StringIndexerModel.load(f"{path}/labels"), facts["features"], facts["accuracy"])
