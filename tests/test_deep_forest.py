import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from quorumkit.operators import deep_forest as D


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    made = [(Vectors.dense(r.randrange(6), r.randrange(6), r.randrange(40), r.randrange(3)), float(r.randrange(5)), r.randrange(1, 60)) for _ in range(3000)]
    return spark.createDataFrame([(f, float((f[0] + f[2]) % 5) if r.random() < 0.7 else y, n) for f, y, n in made], ["features", "label", "n"])


def scores(model, rows):
    got = model.transform(rows.select("features").distinct()).select("features", "prediction", vector_to_array("probability").alias("p"))
    return sorted((tuple(r["features"]), r["prediction"], tuple(round(p, 7) for p in r["p"])) for r in got.collect())


def test_many_deep_trees_take_few_jobs(spark, rows):
    """A forest grown node by node takes jobs by depth and by number of nodes."""
    spark.sparkContext.setJobGroup("forest", "forest")
    model = D.fit_forest(rows, trees=30, depth=30, bins=64, weight="n")
    got = scores(model, rows)
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest")) <= 40
    assert model.nodes.selectExpr("max(length(bin(id))) AS d").first()["d"] > 13
    label = {}
    for f, y, n in rows.collect():
        label.setdefault(tuple(f), {}).setdefault(y, 0)
        label[tuple(f)][y] += n
    right = sum(max(label[f], key=label[f].get) == y for f, y, _ in got)
    assert right > 0.95 * len(got) and all(abs(sum(p) - 1) < 1e-6 for _, _, p in got)


def test_upper_levels_do_not_change_the_trees(rows):
    one, split = (D.fit_forest(rows, trees=4, depth=20, bins=64, weight="n", group_cells=g) for g in (50_000, 150))
    assert split.levels >= 4 and not one.levels
    pick = lambda m: sorted(map(str, m.nodes.where("feature < 0").select("tree", "id", "labels", "shares").collect()))
    # leaves of the split forest that stand above its groups have no other place than in a group, so all leaves are there
    assert pick(one) == pick(split)
    assert scores(one, rows) == scores(split, rows)


def test_cuts_agree_with_brute_force():
    r = np.random.default_rng(3)
    node, bin, label, w = r.integers(0, 6, 400), r.integers(0, 7, 400), r.integers(0, 4, 400), r.integers(1, 9, 400)
    bin[node == 2] = 3
    cost, cut = D.best_cuts(node, bin, label, w, 7)
    for n in range(7):
        best = (np.inf, -1)
        for b in range(7):
            sides = [np.bincount(label[(node == n) & s], w[(node == n) & s], 4) for s in (bin <= b, bin > b)]
            if all(s.sum() for s in sides):
                value = sum(s.sum() - (s * s).sum() / s.sum() for s in sides)
                best = min(best, (value, b)) if value < best[0] - 1e-9 else best
        assert (np.isinf(cost[n]) and np.isinf(best[0])) or (abs(cost[n] - best[0]) < 1e-9 and cut[n] == best[1])


def test_draws_are_poisson():
    u = (np.arange(20_000) + 0.5) / 20_000
    for mean in (1, 7, 40, 3000, 250_000):
        drawn = D.poisson(np.full(20_000, mean), u)
        assert abs(drawn.mean() / mean - 1) < 0.01 and abs(drawn.var() / mean - 1) < 0.02


def test_one_tree_without_cells():
    assert D._bins(pa.array([], pa.list_(pa.int32())), 3).shape == (0, 3)
