"""Boosted stumps against a plain loop, and as stages of Spark ML."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from quorumkit.operators.boosting import StumpBooster, StumpBoosterModel


def samme(x, y, rounds):
    """(feature, limit, left, right, alpha) of each round, by trying every split."""
    w, k, out = np.full(len(y), 1 / len(y)), int(y.max()) + 1, []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= limit
                a, b = np.bincount(y[left], w[left], k), np.bincount(y[~left], w[~left], k)
                impurity = round(a.sum() - (a**2).sum() / a.sum() + b.sum() - (b**2).sum() / b.sum(), 9)
                if best is None or impurity < best[0]:
                    best = impurity, f, limit, int(np.argmax(np.round(a, 9))), int(np.argmax(np.round(b, 9)))
        _, f, limit, left, right = best
        miss = np.where(x[:, f] <= limit, left, right) != y
        error = w[miss].sum()
        if error >= 1 - 1 / k:
            break
        alpha = math.log((1 - max(error, 1e-10)) / max(error, 1e-10)) + math.log(k - 1)
        out.append((f, limit, left, right, alpha))
        w = w * np.exp(alpha * miss)
        w /= w.sum()
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data = []
    for _ in range(150):
        y = rng.randrange(4)
        data.append((float(y if rng.random() < 0.7 else rng.randrange(4)), float(rng.randrange(3) + (y > 1)), float(rng.randrange(2)), float(y)))
    return spark.createDataFrame(data, "a double, b double, c double, label double")


def test_stumps_equal_a_plain_loop(spark, rows):
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    table = np.array(rows.collect())
    model = StumpBooster(rounds=13).fit(ready)  # more rounds than between two writes of the weights
    want = samme(table[:, :3], table[:, 3].astype(int), 13)
    assert [(s[0], s[2], s[3], s[4]) for s in model.stumps] == [t[:4] for t in want]
    assert np.allclose([s[5] for s in model.stumps], [t[4] for t in want])


def test_a_stage_like_any_other(spark, rows, tmp_path):
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="v"), StumpBooster(featuresCol="v", rounds=4, predictionCol="said", probabilityCol="share")])
    fitted = pipeline.fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    first, second = (m.transform(rows).select("a", "b", "c", "said", "share").collect() for m in (fitted, again))
    assert sorted(map(str, first)) == sorted(map(str, second))
    assert all(abs(sum(r["share"]) - 1) < 1e-9 and r["share"][int(r["said"])] == max(r["share"]) for r in first)
    booster = StumpBooster(rounds=1)
    booster.save(str(tmp_path / "e"))
    assert StumpBooster.load(str(tmp_path / "e")).getOrDefault("rounds") == 1
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    grid = ParamGridBuilder().addGrid(booster.rounds, [1, 5]).build()
    best = CrossValidator(estimator=booster, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=2, seed=1).fit(ready)
    assert isinstance(best.bestModel, StumpBoosterModel) and len(best.bestModel.stumps) == 5 and best.avgMetrics[1] > best.avgMetrics[0]


def test_odd_inputs(spark, rows):
    ready = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    none = StumpBooster().fit(ready.where("false"))
    assert none.stumps == [] and none.transform(ready).where("prediction <> 0").count() == 0
    one = StumpBooster().fit(ready.where("label = 0"))
    assert one.transform(ready).where("prediction <> 0").count() == 0
    flat = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows.selectExpr("1.0D AS a", "label"))
    assert StumpBooster(rounds=3).fit(flat).stumps == []
    many = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.range(500).selectExpr("cast(id AS double) AS a", "cast(id >= 250 AS double) AS label"))
    binned = StumpBooster(rounds=1, maxBins=10).fit(many)
    assert abs(binned.stumps[0][2] - 250) < 30 and binned.transform(many).where("prediction <> label").count() < 30
