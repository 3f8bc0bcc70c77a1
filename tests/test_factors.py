import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumkit.operators import factors, synth


def planted(samples, labels, k, seed=3):
    rng = np.random.default_rng(seed)
    strength = np.array([2.0, 1.2, 0.7, 0.5])[:k]
    return rng.normal(size=(samples, k)) * strength @ rng.normal(size=(k, labels)) + rng.normal(size=(samples, labels)) * rng.uniform(0.4, 1.0, labels) + rng.normal(size=labels)


def long(spark, annotator, x):
    n, p = x.shape
    return spark.createDataFrame([(annotator, f"s{i:03}", f"t{j:04}", float(x[i, j])) for i in range(n) for j in range(p)], "annotator string, sample string, taxid string, x double")


def fitted(df, latent, **own):
    out = {}
    for r in sorted(factors.factor_model(df, latent, **own).collect(), key=lambda r: (r["annotator"], r["taxid"])):
        out.setdefault(r["annotator"], []).append(r)
    return {a: (np.array([r["mean"] for r in v]), np.array([r["load"] for r in v]), np.array([r["own"] for r in v]), np.array(v[0]["spread"])) for a, v in out.items()}


def test_loadings_by_grouped_sums_equal_those_of_one_matrix(spark):
    x, y = planted(60, 1000, 3), planted(3, 12, 2, 8)
    got = fitted(long(spark, "wide", x).unionByName(long(spark, "thin", y)), 3, small_cells=100, tolerance=1e-5)
    mean, load, noise, scores = factors.factor_analysis(x, 3, 5000, 1e-9)
    load = factors._signed(load)
    a = got["wide"]
    assert np.abs(a[0] - mean).max() < 1e-9 and a[1].shape == (1000, 3)
    assert np.abs(a[1] - load.T).max() < 2e-3 and np.abs(a[2] - noise).max() < 2e-3
    assert a[3] == pytest.approx(scores.std(0), abs=2e-3)
    assert np.allclose((a[1] ** 2).sum(1) + a[2], x.var(0), rtol=1e-5)
    assert got["thin"][1].shape == (12, 2)  # no more factors than samples less one


def test_odd_values(spark):
    x = planted(6, 5, 2)
    x[:, 3] = 1.5  # a label without variance
    df = long(spark, "k", x).unionByName(long(spark, "one", x[:1]))
    got = fitted(df.unionByName(spark.createDataFrame([("k", None, "t0000", 1.0), (None, "s000", "t0000", 1.0)], df.schema)), 4)
    assert set(got) == {"k"} and np.isfinite(got["k"][1]).all() and np.abs(got["k"][1][3]).max() < 1e-4
    assert factors.factor_model(df.limit(0)).count() == 0


def test_draws_follow_the_model_and_thin_tables_are_cycled(spark):
    rng = np.random.default_rng(1)
    rows = [("k", f"s{s}", f"t{t}", int(rng.poisson(np.exp(3 + 0.2 * t)))) for s in range(8) for t in range(4)] + [("thin", "a", "t", 7), ("thin", "b", "t", 9)]
    df = spark.createDataFrame(rows, "annotator string, sample string, taxid string, n long")
    got = synth.vae(df, 4000, None).groupBy("annotator", "taxid").agg(F.avg(F.log1p("n")).alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    got = {(r["annotator"], r["taxid"]): r for r in got.collect()}
    assert (got["thin", "t"]["low"], got["thin", "t"]["high"]) == (7, 9)
    for t in range(4):
        assert got["k", f"t{t}"]["m"] == pytest.approx(np.mean([np.log1p(n) for a, _, tt, n in rows if a == "k" and tt == f"t{t}"]), abs=0.1)
