"""Factor analysis of samples x labels for many annotators at once, by expectation maximisation over grouped sums.

No task holds a matrix beyond ``SMALL_CELLS`` cells: a step joins the values
with a few numbers of each label, adds them up by sample, and back by label.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumkit.sinks.shared import materialize

#: Labels times samples of an annotator that one task may fit by itself.
SMALL_CELLS = 250_000
#: Steps of expectation maximisation, and the gain in log-likelihood of any annotator that is worth another one.
MOST_STEPS, TOLERANCE = 200, 1e-3
#: A label keeps at least this part of its variance for itself.
LEAST_OWN = 1e-6
SCHEMA = "annotator string, taxid string, mean double, own double, load array<double>, spread array<double>"


def factor_analysis(x: np.ndarray, k: int, steps: int = 200, tol: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mean, loadings, noise, scores) of samples x labels by expectation maximisation."""
    mean, n = x.mean(0), len(x)
    c = x - mean
    noise, last, tiny = c.var(0) + 1e-12, -np.inf, 1e-12
    for _ in range(steps):
        root = np.sqrt(noise) + tiny
        _, sv, vt = np.linalg.svd(c / (root * np.sqrt(n)), full_matrices=False)
        kept = sv[:k] ** 2
        load = np.sqrt(np.maximum(kept - 1, 0))[:, None] * vt[:k] * root
        ll = -0.5 * n * (np.log(np.maximum(kept, tiny)).sum() + (sv[k:] ** 2).sum() + np.log(noise + tiny).sum())
        noise = np.maximum(c.var(0) - (load**2).sum(0), tiny)
        if ll - last < tol:
            break
        last = ll
    weighted = load / noise
    scores = c @ weighted.T @ np.linalg.inv(np.eye(len(load)) + weighted @ load.T)
    return mean, load, noise, scores


def _most(samples: int, labels: int, latent: int) -> int:
    return max(1, min(latent, samples - 1, labels - 1))


def _signed(load: np.ndarray) -> np.ndarray:
    """Factors (rows) turned so that their loadings have no negative sum."""
    return load * np.where(load.sum(1, keepdims=True) < 0, -1.0, 1.0)


def _fit_alone(latent: int, tolerance: float):
    """One annotator's small matrix in one task."""

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.pivot_table(index="sample", columns="taxid", values="x", aggfunc="sum", fill_value=0.0).sort_index().sort_index(axis=1)
        mean, load, noise, scores = factor_analysis(x.to_numpy(float), _most(*x.shape, latent), tol=tolerance)
        n = x.shape[1]
        return pd.DataFrame({"annotator": key[0], "taxid": x.columns, "mean": mean, "own": noise, "load": list(_signed(load).T), "spread": [scores.std(0)] * n})

    return fit


def _products(left: list[Column], right: list[Column], name: str) -> list[Column]:
    return [F.sum(a * b).alias(f"{name}{i}_{j}") for i, a in enumerate(left) for j, b in enumerate(right)]


def _matrices(rows: DataFrame, sums: list[Column], k: int) -> dict[str, np.ndarray]:
    """One k x k matrix of each annotator: as many rows as annotators come to the driver."""
    return {r[0]: np.array(r[1:], float).reshape(k, k) for r in rows.groupBy("annotator").agg(*sums).collect()}


def _times(rows: DataFrame, names: list[str], by: dict[str, np.ndarray], out: list[str]) -> DataFrame:
    """Rows whose vector ``names`` is multiplied from the right by their annotator's matrix."""
    k = len(names)
    cells = [f"__m{i}_{j}" for i in range(k) for j in range(k)]
    table = rows.sparkSession.createDataFrame([(a, *map(float, m.ravel())) for a, m in by.items()], "annotator string, " + ", ".join(f"{c} double" for c in cells))
    product = {o: sum((F.col(n) * F.col(f"__m{i}_{j}") for i, n in enumerate(names)), F.lit(0.0)) for j, o in enumerate(out)}
    # one row for each annotator
    return rows.join(F.broadcast(table), "annotator").withColumns(product).drop(*cells)


def _fit_together(values: DataFrame, sizes: dict[str, tuple[int, int]], latent: int, tolerance: float) -> DataFrame:
    """Annotators of any size at once; sizes: samples and labels of each.

    Every step is one of expectation maximisation with expanded parameters, so
    that loadings and noise always add up to a label's variance.
    """
    own_k = {a: _most(n, p, latent) for a, (n, p) in sizes.items()}
    k = max(own_k.values())
    w, m, s = ([f"{c}{i}" for i in range(k)] for c in "wms")
    means = materialize(values.groupBy("annotator", "taxid").agg(F.avg("x").alias("mean")))
    cells = materialize(values.join(means, ["annotator", "taxid"]).select("annotator", "sample", "taxid", (F.col("x") - F.col("mean")).alias("c")))
    variance = F.avg(F.col("c") * F.col("c")).alias("variance")
    of_factors = F.create_map(*(F.lit(v) for pair in own_k.items() for v in pair))
    draw = lambda i: F.pmod(F.xxhash64(F.lit(i), "annotator", "taxid"), F.lit(1 << 20)) / float(1 << 20) - 0.5
    start = {c: F.when(F.lit(i) < of_factors[F.col("annotator")], draw(i) * F.sqrt("variance")).otherwise(0.0) for i, c in enumerate(w)}
    labels = cells.groupBy("annotator", "taxid").agg(variance).withColumn("own", F.col("variance") + 1e-12).withColumns(start)
    labels, last = materialize(labels), {}
    # what a label's value says of each factor
    said = [F.col(c) / F.col("own") for c in w]
    for step in range(MOST_STEPS + 1):
        sums = _products([F.col(c) for c in w], said, "g")
        rows = labels.groupBy("annotator").agg(*sums, F.sum(F.log("own")), F.sum(F.col("variance") / F.col("own"))).collect()  # one row for each annotator
        gram = {r[0]: np.array(r[1:-2], float).reshape(k, k) for r in rows}
        inverse = {a: np.linalg.inv(np.eye(k) + (g + g.T) / 2) for a, g in gram.items()}
        told = cells.join(labels, ["annotator", "taxid"]).groupBy("annotator", "sample").agg(*(F.sum(F.col("c") * x).alias(o) for x, o in zip(said, s)))
        scores = materialize(_times(told, s, inverse, m).select("annotator", "sample", *m))
        seen = _matrices(scores, _products([F.col(c) for c in m], [F.col(c) for c in m], "z"), k)
        fit = {r[0]: -0.5 * (sizes[r[0]][0] * (r[-2] - np.linalg.slogdet(inverse[r[0]])[1] + r[-1]) - np.trace(np.linalg.solve(inverse[r[0]], seen[r[0]]))) for r in rows}
        settled = last and all(v - last[a] < tolerance for a, v in fit.items())
        last = fit
        if settled or step == MOST_STEPS:
            break
        turn = {}
        for a, z in seen.items():
            both = sizes[a][0] * inverse[a] + (z + z.T) / 2
            turn[a] = np.linalg.solve(both, np.linalg.cholesky(both / sizes[a][0]))
        moved = cells.join(scores, ["annotator", "sample"]).groupBy("annotator", "taxid").agg(variance, *(F.sum(F.col("c") * F.col(o)).alias(f"s{i}") for i, o in enumerate(m)))
        rest = F.col("variance") - sum((F.col(c) * F.col(c) for c in w), F.lit(0.0))
        labels = materialize(_times(moved, s, turn, w).select("annotator", "taxid", "variance", F.greatest(rest, F.col("variance") * LEAST_OWN + 1e-12).alias("own"), *w))
    axes = {a: np.linalg.eigh((g + g.T) / 2)[1][:, ::-1] for a, g in gram.items()}
    total = {r[0]: np.array(r[1:]) for r in _times(labels, w, axes, s).groupBy("annotator").agg(*(F.sum(c) for c in s)).collect()}  # one row for each annotator
    axes = {a: v * np.where(total[a] < 0, -1.0, 1.0) for a, v in axes.items()}
    spread = {a: np.sqrt(np.maximum(np.diag(axes[a].T @ z @ axes[a]) / sizes[a][0], 0)) for a, z in seen.items()}
    spreads = values.sparkSession.createDataFrame([(a, v[: own_k[a]].tolist()) for a, v in spread.items()], "annotator string, spread array<double>")
    out = _times(labels, w, axes, s).join(means, ["annotator", "taxid"]).join(F.broadcast(spreads), "annotator")
    return out.select("annotator", "taxid", "mean", "own", F.slice(F.array(*s), 1, F.size("spread")).alias("load"), "spread")


def factor_model(values: DataFrame, latent: int = 4, small_cells: int = SMALL_CELLS, tolerance: float = TOLERANCE) -> DataFrame:
    """(annotator, taxid, mean, own, load, spread) from complete rows (annotator, sample, taxid, x), each once.

    load: a label's loading on each of at most ``latent`` factors, the
    strongest first; own: what is left of its variance; spread: the deviation of
    each factor's scores, the same on every row of an annotator. Loadings are
    orthogonal in units of the labels' own variance; each factor points to where
    its loadings have no negative sum. Annotators with fewer than two labels or
    samples have no rows. Null annotators, labels and samples take no part. Up to
    ``small_cells`` cells of an annotator are fitted in one task.
    """
    values = values.where("annotator IS NOT NULL AND taxid IS NOT NULL AND sample IS NOT NULL")
    counts = values.groupBy("annotator").agg(F.countDistinct("sample"), F.countDistinct("taxid")).where("`count(DISTINCT sample)` > 1 AND `count(DISTINCT taxid)` > 1")
    sizes = {a: (n, p) for a, n, p in counts.collect()}  # one row for each annotator
    small = [a for a, (n, p) in sizes.items() if n * p <= small_cells]
    large = {a: v for a, v in sizes.items() if a not in small}
    out = values.where(F.col("annotator").isin(small)).groupBy("annotator").applyInPandas(_fit_alone(latent, tolerance), SCHEMA)
    if large:
        out = out.unionByName(_fit_together(values.where(F.col("annotator").isin(list(large))), large, latent, tolerance))
    return out
