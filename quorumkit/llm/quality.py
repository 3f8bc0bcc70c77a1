"""Document quality by hierarchical empirical Bayes.

A document classifier gives each document its own evidence. The evidence of a
host's documents, and of each path group below a host, updates a prior: global
odds for hosts, the host's posterior for its paths. Prior strengths come from
the data by the method of moments, so a site with few documents stays near the
level above it. A document's score adds the site's shift of the odds to its own.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_CODEC, materialize, release_memory
from .logit import fit_logistic

#: Labelled rows that the document classifier is fitted on, at most; the first in hash order.
MAX_LABELLED = 20_000
#: Documents below this score are rejected.
THRESHOLD = 0.5
#: Share of a site's shift that a document's odds take over.
SITE_WEIGHT = 0.5
#: Hosts up to which the site table is broadcast (about 100 bytes each); more go by a shuffle join.
MAX_BROADCAST_SITES = 200_000
_CUTS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.7)


def text_shape(text: str | None) -> list[float]:
    """Shares that tell running prose from junk, each between 0 and about 1."""
    t = text or ""
    words = t.split()
    n, chars = max(1, len(words)), max(1, len(t))
    upper = sum(map(str.isupper, words))
    marks = sum(map(t.count, "!#$%&*|~^@<>{}[]\\=+_"))
    alone = sum(not w[:1].isalnum() for w in words)
    distinct = len(set(words))
    repeat = sum(a == b for a, b in zip(words, words[1:]))
    top = Counter(words).most_common(1)[0][1] if words else 0
    lines = [x for x in t.split("\n") if x]
    tailed = sum(not w[-1].isalnum() and w[-1] not in ".,;:?)\"'" for w in words)
    return [
        upper / n,
        marks / chars * 5,
        alone / n,
        1 - distinct / n,
        repeat / n,
        top / n,
        1 - len(set(lines)) / max(1, len(lines)),
        tailed / n,
        min(1.0, len(lines) / n),
        sum(map(str.isdigit, t)) / chars,
        min(1.0, max(map(len, words), default=0) / 200),
        1 / (1 + n / 20),
    ]


N_SHAPE = len(text_shape(""))


def _features(texts) -> np.ndarray:
    """Shares, and for each share which cuts it exceeds."""
    x = np.array([text_shape(t) for t in texts], float).reshape(-1, N_SHAPE)
    return np.concatenate([x, *((x > c).astype(float) for c in _CUTS)], axis=1)


def fit_classifier(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights of the document classifier, from at most MAX_LABELLED labelled rows.

    Rows with a null id or label take no part; of several labels of one document the least holds.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(21)), "doc_id").limit(MAX_LABELLED)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # at most MAX_LABELLED ids

    def shape(batches):
        for b in batches:
            x = [text_shape(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("y")], names=["x", "y"])

    got = rows.select("text", "y").mapInArrow(shape, "x array<double>, y int").toArrow().to_pandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, N_SHAPE)
    x = np.concatenate([x, *((x > c).astype(float) for c in _CUTS)], axis=1)
    return fit_logistic(x, got["y"].to_numpy(float), ridge=3e-4)


def evidence(text: Column, weights: np.ndarray) -> Column:
    """The document classifier's log odds of good quality for each whole text; null counts as empty."""

    @F.arrow_udf("double")
    def log_odds(texts: pa.Array) -> pa.Array:
        out = pa.array(np.clip(_features(t.as_py() for t in texts) @ weights[:-1] + weights[-1], -12, 12))
        release_memory()
        return out

    return log_odds(F.coalesce(text.cast("string"), F.lit("")))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(mean: Column, variance: Column) -> Column:
    """Prior strength of a beta distribution with this mean and variance, from 2 to 1000."""
    return F.least(F.greatest(F.coalesce(mean * (1 - mean) / F.greatest(variance, F.lit(1e-9)) - 1, F.lit(1000.0)), F.lit(2.0)), F.lit(1000.0))


def site_posteriors(rows: DataFrame) -> DataFrame:
    """(host, path, host_p, path_p, global_p) from rows with host, path and p (a probability).

    Rows are added up by (host, path) before anything else, map side first, so
    a host with a third of all rows is one row for each task. Null hosts and
    paths are groups of their own.
    """
    paths = materialize(rows.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")))
    hosts = paths.groupBy(F.col("host").alias("of")).agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    spread = lambda p, n, m: F.greatest(F.sum(n * (p - m) * (p - m)) / F.sum(n) - m * (1 - m) / F.avg(n), F.lit(0.0))
    total = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = float((total["s"] or 0) / total["n"]) if total["n"] else 0.5
    m = F.lit(mean)
    across = hosts.agg(spread(F.col("hs") / F.col("hn"), F.col("hn"), m).alias("v")).select(_strength(m, F.col("v")).alias("k")).first()["k"]
    hosts = hosts.withColumn("host_p", (F.col("hs") + across * m) / (F.col("hn") + across))
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).select("host", "path", "s", "n", "host_p")
    off = F.col("s") / F.col("n") - F.col("host_p")
    within = joined.agg(F.greatest(F.sum(F.col("n") * off * off) / F.sum("n") - m * (1 - m) / F.avg("n"), F.lit(0.0)).alias("v")).select(_strength(m, F.col("v")).alias("k")).first()["k"]
    path_p = (F.col("s") + within * F.col("host_p")) / (F.col("n") + within)
    return joined.select("host", "path", "host_p", path_p.alias("path_p"), m.alias("global_p"))


def with_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, name: str = "quality_score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Add quality_score (0 to 1) of each document.

    host and path are columns of docs. The columns named by ``keep`` stay (all,
    if none are named; one named like the score is replaced). Null and empty
    texts are scored like any other (by their shape), repeated rows alike; rows
    of unknown site have a site of their own; no rows give no rows. The
    classifier runs once: what it found is written with the kept columns.
    """
    weights = fit_classifier(docs, labels)
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    scored = materialize(docs.select(row, host.cast("string").alias("host"), path.cast("string").alias("path"), evidence(F.col("text"), weights).alias("own")), compression=TEXT_CODEC)
    sites = materialize(site_posteriors(scored.select("host", "path", (1 / (1 + F.exp(-F.col("own")))).alias("p")))).withColumnsRenamed({"host": "h", "path": "q"})
    small = sites.count() <= MAX_BROADCAST_SITES
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))
    joined = scored.join(F.broadcast(sites) if small else sites, same, "left")
    shift = F.coalesce(_logit(F.col("path_p")) - _logit(F.col("global_p")), F.lit(0.0))
    total = F.col("own") + SITE_WEIGHT * shift
    return joined.select("row.*", (1 / (1 + F.exp(-total))).alias(name))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality_score and keep for every document; host is source, path is source and language."""
    out = with_quality(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), keep=("doc_id",))
    return out.select("doc_id", "quality_score", (F.col("quality_score") >= THRESHOLD).alias("keep"))

