"""Synthetic abundance profiles: long abundance in, long abundance out.

Randomness is drawn for each (annotator, sample) from a generator
seeded by the seed and the names, so results do not depend on how Spark
deals the groups out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumkit.operators import abundance as A
from quorumkit.operators import factors, forests
from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize

MODES = {"direct": "direct", "preserve": "direct", "bootstrap": "bootstrap", "vae": "vae", "fa": "vae", "glm": "glm", "glm_python": "glm"}
DEFAULTS = {"threshold": 1e-5, "seed": 42, "latent": 4, "error": 0.15, "noise": 0.15, "min_cluster": 2, "max_cluster": 100}
_SCHEMA = "annotator string, sample string, taxid string, n double"


def normalize_mode(mode: str | None, aliases: Mapping[str, str] | None = None) -> str:
    """One of direct, bootstrap, vae and glm; ``aliases`` are further names a caller knows them by."""
    known = MODES | dict(aliases or {})
    key = (mode or "direct").strip().lower().replace("-", "_")
    if key not in known:
        raise ValueError(f"unknown mode {mode!r}; one of {sorted(known)}")
    return known[key]


def settings(**own) -> dict:
    """Defaults with own values; both spellings of the threshold's old name are known."""
    for old in ("threshold_amount", "treshhold_amount"):
        if old in own:
            own["threshold"] = own.pop(old)
    return DEFAULTS | own


def synthetic_samples(abundance: DataFrame, n_samples: int | None) -> DataFrame:
    """annotator, name, source, place: observed names, truncated or repeated as <name>_r2, <name>_r3."""
    names = abundance.groupBy("annotator").agg(F.sort_array(F.collect_set("sample")).alias("s"))
    n = F.lit(int(n_samples)) if n_samples and n_samples > 0 else F.size("s")
    each = names.select("annotator", "s", F.explode(F.sequence(F.lit(0), n - 1)).alias("place"))
    source = F.get("s", (F.col("place") % F.size("s")).cast("int"))
    turn = F.floor(F.col("place") / F.size("s")) + 1
    return each.select("annotator", F.when(turn == 1, source).otherwise(F.concat(source, F.lit("_r"), turn.cast("string"))).alias("name"), source.alias("source"), "place")


def _rng(*parts) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.sha256("/".join(map(str, parts)).encode()).digest()[:8], "little"))


def finish(profile: DataFrame, n_reads: int | None, rescale: bool) -> DataFrame:
    """Scale to exactly n_reads or round plainly, and drop labels without any count."""
    done = A.scale_exact(profile, n_reads if rescale else None)
    return A.drop_zero_labels(done)


def direct(abundance: DataFrame, n_reads: int | None = None, rescale: bool = False, **own) -> DataFrame:
    """The observed profile, filtered and scaled."""
    s = settings(**own)
    kept = A.filter_labels(A.complete(abundance), s["threshold"], n_reads, rescale)
    return finish(kept, n_reads, rescale)


def bootstrap(abundance: DataFrame, n_samples: int | None = None, n_reads: int | None = None, rescale: bool = False, **own) -> DataFrame:
    """Noisy copies of observed samples: Dirichlet shares, then a multinomial draw.

    Sources, totals and the Dirichlet's parameters are columns; a task only
    draws one synthetic sample. Extra names draw their source from all.
    """
    s = settings(**own)
    seed, strength = s["seed"], max(1.0, 1.0 / max(s["error"], 1e-6))
    observed = A.complete(abundance).withColumn("n", F.greatest(F.col("n").cast("double"), F.lit(0.0)))
    totals = observed.groupBy("annotator", "sample").agg(F.round(F.sum("n")).cast("long").alias("total"), F.sum("n").alias("mass"))
    names = synthetic_samples(abundance, n_samples).withColumn("extra", F.col("name") != F.col("source"))
    pool = names.groupBy("annotator").agg(F.sort_array(F.collect_set("source")).alias("pool"))
    lot = F.pmod(F.xxhash64("annotator", "name", F.lit(seed)), F.size("pool")).cast("int")
    origin = names.join(pool, "annotator").select("annotator", "name", F.when(F.col("extra"), F.get("pool", lot)).otherwise(F.col("source")).alias("sample"))
    alpha = F.coalesce(F.try_divide(F.col("n") * strength, F.col("mass")), F.lit(0.0)) + 0.05
    urns = origin.join(totals, ["annotator", "sample"]).join(observed, ["annotator", "sample"]).select("annotator", "name", "total", "taxid", alpha.alias("alpha"))

    def draw(key: tuple, urn: pd.DataFrame) -> pd.DataFrame:
        urn = urn.sort_values("taxid", ignore_index=True)
        gamma = np.maximum(_rng(seed, *key).standard_gamma(urn["alpha"]), 1e-300)
        counts = _rng(seed, *key, "counts").multinomial(urn["total"].iloc[0], gamma / gamma.sum())
        return pd.DataFrame({"annotator": key[0], "sample": key[1], "taxid": urn["taxid"], "n": counts.astype(float)})

    synthetic = urns.groupBy("annotator", "name").applyInPandas(draw, _SCHEMA)
    return finish(A.filter_labels(synthetic, s["threshold"], n_reads, rescale), n_reads, rescale)


def vae(abundance: DataFrame, n_samples: int | None = None, n_reads: int | None = 1000, rescale: bool = False, **own) -> DataFrame:
    """Profiles decoded from random scores of a factor analysis of log counts.

    With fewer than two labels or samples the observed columns are cycled. The
    model is a table of labels; scores are hashes of names turned into normal
    numbers, so results do not depend on how rows are dealt out.
    """
    s = settings(**own)
    kept = A.filter_labels(A.complete(abundance), s["threshold"], n_reads, rescale)
    kept = materialize(kept.select("annotator", "sample", "taxid", F.col("n").cast("double").alias("n")))
    names = synthetic_samples(abundance, n_samples)
    model = materialize(factors.factor_model(kept.select("annotator", "sample", "taxid", F.log1p(F.greatest("n", F.lit(0.0))).alias("x")), s["latent"]))
    score = lambda i: F.when(F.get("spread", F.lit(i)) > 0, F.get("spread", F.lit(i))).otherwise(1.0) * _normal(s["seed"], i, "annotator", "name")
    spreads = model.groupBy("annotator").agg(F.first("spread").alias("spread"))
    drawn = names.select("annotator", "name").join(spreads, "annotator").select("annotator", "name", *(score(i).alias(f"z{i}") for i in range(s["latent"])))
    level = sum((F.coalesce(F.get("load", F.lit(i)) * F.col(f"z{i}"), F.lit(0.0)) for i in range(s["latent"])), F.col("mean"))
    decoded = model.drop("spread", "own").join(drawn, "annotator").select("annotator", F.col("name").alias("sample"), "taxid", F.round(F.expm1(F.greatest(level, F.lit(0.0))), 6).alias("n"))
    thin = names.join(spreads, "annotator", "left_anti").select("annotator", "name", F.col("source").alias("sample"))
    cycled = thin.join(kept, ["annotator", "sample"]).select("annotator", F.col("name").alias("sample"), "taxid", "n")
    return finish(decoded.unionByName(cycled), n_reads, rescale)


def cluster_labels(corr: np.ndarray, min_size: int = 2, max_size: int = 100) -> np.ndarray:
    """Average-linkage clusters on 1 - |corr|; max(n / min_size, ceil(n / max_size)) of them."""
    n = len(corr)
    wanted = min(n, max(n // max(1, min_size), 1, -(-n // max(1, max_size))))
    if wanted <= 1:
        return np.zeros(n, int)
    dist = np.clip(1 - np.abs(corr), 0, 2).astype(float)
    np.fill_diagonal(dist, np.inf)
    size, own, alive = np.ones(n), np.arange(n), n
    while alive > wanted:
        i, j = divmod(int(np.argmin(dist)), n)
        i, j = min(i, j), max(i, j)
        merged = (dist[i] * size[i] + dist[j] * size[j]) / (size[i] + size[j])
        dist[i], dist[:, i] = merged, merged
        dist[i, i] = np.inf
        dist[j], dist[:, j] = np.inf, np.inf
        size[i] += size[j]
        own[own == j] = i
        alive -= 1
    return np.unique(own, return_inverse=True)[1]


def _lot(*parts: str | Column | int) -> Column:
    """A number in [0, 1) from the hash of names and numbers."""
    return F.pmod(F.xxhash64(*(F.lit(p) if isinstance(p, int) else p for p in parts)), F.lit(1 << 52)) / float(1 << 52)


def _normal(*parts: str | Column | int) -> Column:
    """A normally distributed number from the hash of names and numbers."""
    return F.sqrt(-2 * F.log(1 - _lot(0, *parts))) * F.cos(2 * math.pi * _lot(1, *parts))


def _against_known(rows: DataFrame, known: DataFrame, keys: list[str], lot: Column) -> DataFrame:
    """Add ``bar``: one of the known probabilities (keys, prob) of a row's keys, chosen by ``lot``; 1 where none is known."""
    numbered = running_sum(known.where("prob > 0").select(*keys, F.round("prob", 12).alias("prob")), keys, ["prob"], name="at")
    counts = numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("many"))
    asked = rows.join(counts, keys, "left").withColumn("at", F.floor(lot * F.col("many")))
    return asked.join(numbered.withColumnRenamed("prob", "bar"), [*keys, "at"], "left").withColumn("bar", F.coalesce("bar", F.lit(1.0))).drop("at", "many")


def _both_ways(forest: DataFrame, fits: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges (keys, a, b, base, slope) of a forest whose group is the struct of the keys."""
    ways = forest.select("g.*", "a", "b").unionByName(forest.select("g.*", F.col("b").alias("a"), F.col("a").alias("b")))
    return ways.join(fits.select(*keys, "a", "b", F.col("intercept").alias("base"), "slope"), [*keys, "a", "b"])


def _walk(tree: DataFrame, starts: DataFrame, keys: list[str], noise: float, seed: int) -> DataFrame:
    """(keys, name, node, value): values of the nodes of a tree, going out from a start along fits, with noise on every step.

    starts: keys, name, start and level. A task walks the tree of one sample:
    as many edges as the sample gets values.
    """

    def go(frame: pd.DataFrame) -> pd.DataFrame:
        own = tuple(frame[k].iloc[0] for k in [*keys, "name"])
        rng, near = _rng(seed, *own), {}
        for e in frame.dropna(subset=["a"]).sort_values(["a", "b"]).itertuples():
            near.setdefault(e.a, []).append((e.b, e.base, e.slope))
        start = frame["start"].iloc[0]
        value, todo = {start: max(0.0, float(frame["level"].iloc[0]))}, [start]
        for at in todo:
            for node, base, slope in near.get(at, ()):
                if node not in value:
                    value[node] = max(0.0, (base + slope * value[at]) * rng.normal(1.0, noise))
                    todo.append(node)
        return pd.DataFrame({**{k: v for k, v in zip([*keys, "name"], own)}, "node": list(value), "value": list(value.values())})

    schema = ", ".join(f"{k} string" for k in [*keys, "name"]) + ", node string, value double"
    return starts.join(tree, keys, "left").groupBy(*keys, "name").applyInPandas(go, schema)


def glm(abundance: DataFrame, n_samples: int | None = None, n_reads: int | None = 1000, rescale: bool = False, **own) -> DataFrame:
    """Profiles that spread over spanning trees of pairwise regressions of clustered labels.

    Pairs, clusters and trees are tables over all annotators at once. A sample
    starts at one of the observed labels with one of its observed counts; which
    clusters, and which labels of a cluster, come with it is drawn against the
    known co-occurrence probabilities; counts follow the regressions along the
    tree of cluster means, then along each cluster's tree. The filter comes
    first: it bounds the pairs. Lots are hashes of names, so results do not
    depend on how rows are dealt out.
    """
    s = settings(**own)
    seed, noise = s["seed"], s["noise"]
    kept = A.filter_labels(A.complete(abundance), s["threshold"], n_reads, rescale)
    kept = materialize(kept.select("annotator", "sample", "taxid", F.greatest(F.col("n").cast("double"), F.lit(0.0)).alias("n")))
    names = synthetic_samples(abundance, n_samples).select("annotator", "name")
    pairs = materialize(A.pair_statistics(kept).withColumns({"r2": F.round("r2", 9), "corr": F.round("corr", 9)}))
    seen = kept.groupBy("annotator", "taxid").agg(F.avg("n").alias("mean"), F.max("n").alias("top"))
    far = pairs.where("a < b").select(F.col("annotator").alias("g"), "a", "b", (1 - F.abs("corr")).alias("d"))
    linked = forests.average_linkage(seen.select(F.col("annotator").alias("g"), F.col("taxid").alias("node")), far, s["min_cluster"], s["max_cluster"])
    labels = materialize(seen.join(linked.select(F.col("g").alias("annotator"), F.col("node").alias("taxid"), "cluster"), ["annotator", "taxid"]))
    clusters = labels.groupBy("annotator", "cluster").agg(F.avg("mean").alias("cmean"))
    means = kept.join(labels.select("annotator", "taxid", "cluster"), ["annotator", "taxid"]).groupBy("annotator", "sample", "cluster").agg(F.avg("n").alias("n"))
    between = materialize(A.pair_statistics(means.withColumnRenamed("cluster", "taxid")).withColumn("r2", F.round("r2", 9)))
    of = lambda side: labels.select("annotator", F.col("taxid").alias(side), F.col("cluster").alias(f"c{side}"))
    within = materialize(pairs.join(of("a"), ["annotator", "a"]).join(of("b"), ["annotator", "b"]).where("ca = cb").withColumnRenamed("ca", "cluster").drop("cb"))
    trees = [_both_ways(forests.spanning_forest(fits.select(F.struct(*keys).alias("g"), "a", "b", F.col("r2").alias("w"))), fits, keys) for fits, keys in ((between, ["annotator"]), (within, ["annotator", "cluster"]))]

    def one_of(rows: DataFrame, by: list[str], salt: int, *values: str) -> DataFrame:
        """One row for each ``by`` and name, by lot."""
        return rows.groupBy(*by, "name").agg(F.min(F.struct(F.xxhash64(F.lit(seed), F.lit(salt), *by, "name", values[0]).alias("lot"), *values)).alias("one")).select(*by, "name", *(f"one.{v}" for v in values))

    ever = labels.where("top > 0")
    start = one_of(names.join(ever, "annotator"), ["annotator"], 1, "taxid", "cluster", "mean")
    levels = one_of(start.select("annotator", "name", "taxid").join(kept.where("n > 0"), ["annotator", "taxid"]), ["annotator"], 2, "sample", "n")
    root = start.join(levels.select("annotator", "name", F.col("n").alias("level")), ["annotator", "name"]).withColumnsRenamed({"taxid": "start", "cluster": "home"})
    root = materialize(root.join(clusters.withColumnRenamed("cluster", "home"), ["annotator", "home"]))
    expected = _walk(trees[0], root.select("annotator", "name", F.col("home").alias("start"), (F.col("level") * F.col("cmean") / F.col("mean")).alias("level")), ["annotator"], noise, seed)

    def drawn(rows: DataFrame, fits: DataFrame, alone: DataFrame, keys: list[str], first: str, node: str, salt: int) -> DataFrame:
        """Rows whose node is the first one or more probable beside it than a known probability that is drawn."""
        prob = fits.select(*keys, F.col("a").alias(first), F.col("b").alias(node), "prob")
        known = fits.select(*keys, "prob").unionByName(alone.select(*keys, F.lit(1.0).alias("prob")))
        asked = _against_known(rows.join(prob, [*keys, first, node], "left"), known, keys, _lot(seed, salt, *keys, "name", node))
        return asked.where((F.col(first) == F.col(node)) | (F.round(F.coalesce("prob", F.lit(0.0)), 12) > F.col("bar"))).drop("prob", "bar")

    there = drawn(root.select("annotator", "name", "home", "start", "mean", "level").join(clusters, "annotator"), between, clusters, ["annotator"], "home", "cluster", 3)
    there = materialize(there.join(expected.withColumnRenamed("node", "cluster"), ["annotator", "name", "cluster"], "left"))
    chosen = one_of(there.select("annotator", "name", "cluster").join(ever, ["annotator", "cluster"]), ["annotator", "cluster"], 4, "taxid", "mean").withColumnsRenamed({"taxid": "some", "mean": "some_mean"})
    at_home = F.col("home") == F.col("cluster")
    begin = there.join(chosen, ["annotator", "name", "cluster"]).select("annotator", "cluster", "name", F.when(at_home, F.col("start")).otherwise(F.col("some")).alias("start"), F.when(at_home, F.col("level")).otherwise(F.coalesce("value", F.lit(0.0)) * F.col("some_mean") / F.col("cmean")).alias("level"))
    begin = materialize(begin)
    values = _walk(trees[1], begin, ["annotator", "cluster"], noise, seed + 1).withColumnRenamed("node", "taxid")
    present = drawn(begin.select("annotator", "cluster", "name", "start").join(labels.select("annotator", "cluster", "taxid"), ["annotator", "cluster"]), within, labels, ["annotator", "cluster"], "start", "taxid", 5)
    counts = present.join(values, ["annotator", "cluster", "name", "taxid"]).select("annotator", "name", "taxid", F.col("value").alias("n"))
    every = names.join(labels.select("annotator", "taxid"), "annotator").join(counts, ["annotator", "name", "taxid"], "left")
    profile = materialize(every.select("annotator", F.col("name").alias("sample"), "taxid", F.round(F.coalesce("n", F.lit(0.0)), 6).alias("n")))
    return finish(profile, n_reads, rescale)


def regenerate(abundance: DataFrame, mode: str = "direct", n_samples: int | None = None, n_reads: int | None = None, rescale: bool = False, **own) -> DataFrame:
    """Abundance after one of the modes direct, bootstrap, vae and glm."""
    mode = normalize_mode(mode)
    if mode == "direct":
        return direct(abundance, n_reads, rescale, **own)
    return {"bootstrap": bootstrap, "vae": vae, "glm": glm}[mode](abundance, n_samples, n_reads, rescale, **own)


def sample_tables(abundance: DataFrame, annotators: list[str]) -> DataFrame:
    """Annotator-major to sample-major: one column N_<annotator> each."""
    return A.merge_tables(abundance, annotators)


