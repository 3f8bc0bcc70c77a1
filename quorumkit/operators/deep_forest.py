"""Random forest of deep trees as a stage of Spark ML.

Features are cut into bins and rows with equal bins and label become one cell
with a weight. A tree's bootstrap draws each cell a Poisson number of times, as
often as its rows together would be drawn, from a hash of cell and tree. Upper
levels are split from grouped histograms of all trees at once, until a node
holds about GROUP_CELLS cells; below, every node of every tree is a group of its
own that a task grows level by level. No tree is ever whole in one place: the
nodes are a table, and rows to be scored meet the nodes of their group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumkit.operators.boosting import bin_limits, bins_of
from quorumkit.sinks.shared import materialize

#: Cells of a node that one task grows; nodes with more are split by histograms first.
GROUP_CELLS = 50_000
#: A node's number is a path of one bit for each level.
MOST_DEPTH = 60
_U = np.uint64
_NODES = "tree int, top long, id long, feature int, cut int, labels array<int>, shares array<double>"
Top = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # of a tree: numbers of its upper nodes, their features and cuts


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def poisson(mean: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Poisson numbers by inversion: those of each mean (a whole number from 1) at places ``at`` in [0, 1) of its distribution."""
    out = np.zeros(len(mean), np.int64)
    order = np.argsort(mean, kind="stable")
    values, first = np.unique(mean[order], return_index=True)
    for m, rows in zip(values.tolist(), np.split(order, first[1:])):
        low, high = max(0, int(m - 9 * math.sqrt(m))), int(m + 9 * math.sqrt(m)) + 9
        k = np.arange(low + 1, high)
        share = np.exp(np.concatenate([[0.0], np.cumsum(math.log(m) - np.log(k))]) - m + low * math.log(m) - math.lgamma(low + 1))
        out[rows] = low + np.searchsorted(np.cumsum(share), at[rows], side="right")
    return out


def best_cuts(node: np.ndarray, bin: np.ndarray, label: np.ndarray, w: np.ndarray, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node the least weighted Gini sum of two sides (inf: one bin only) and the last bin of its left side; of equal ones the first.

    Weights are whole numbers, so sums do not depend on the order of rows.
    """
    labels, bins = int(label.max()) + 1, int(bin.max()) + 1
    order = np.argsort((node * labels + label) * bins + bin, kind="stable")
    group, w = (node * labels + label)[order], w[order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, len(group)))
    before = np.cumsum(w) - w
    before -= np.repeat(before[first], size)
    total = np.repeat(np.add.reduceat(w, first), size)
    place = (node * bins + bin)[order]
    along = np.argsort(place, kind="stable")
    place = place[along]
    sums = [np.cumsum(c[along]) for c in (w, w * (2 * before + w), w * total)]  # weight, squares of the left side's labels, products with all of a label
    last = np.flatnonzero(np.append(place[1:] != place[:-1], True))  # a bin's last row
    of = place[last] // bins
    head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    count = np.diff(np.append(head, len(of)))
    left, l2, lt = (s[last] - np.repeat(np.concatenate([[0], s[last][head[1:] - 1]]), count) for s in sums)
    end = np.repeat(head + count - 1, count)
    right, r2 = left[end] - left, lt[end] - 2 * lt + l2
    inner = right > 0
    cost = np.full(len(of), np.inf)
    cost[inner] = left[inner] - l2[inner] / left[inner] + right[inner] - r2[inner] / right[inner]
    least = np.minimum.reduceat(cost, head)
    at = np.minimum.reduceat(np.where(cost == np.repeat(least, count), np.arange(len(of)), len(of)), head)
    impurity, cut = np.full(n_nodes, np.inf), np.full(n_nodes, -1, np.int64)
    impurity[of[head]], cut[of[head]] = least, place[last][at] % bins
    return impurity, cut


def _chosen(tree: int, nodes: np.ndarray, varied: np.ndarray, picks: int, seed: int) -> np.ndarray:
    """Which features each node tries: ``picks`` random ones of those that vary in it."""
    own = _mix(nodes.astype(_U) ^ _mix(np.full(len(nodes), tree * 1_000_003 + seed, _U)))
    lot = _mix(own[:, None] + np.arange(1, varied.shape[1] + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) >> _U(1)
    lot[~varied] = ~_U(0)
    return varied & (np.argsort(np.argsort(lot, axis=1, kind="stable"), axis=1, kind="stable") < picks)


def _walk(x: np.ndarray, at: np.ndarray, ids: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Where rows end that go down from nodes ``at``; ids ascend, and rows stay at a node that is not there or is a leaf (no feature)."""
    at = at.copy()
    going = np.arange(len(at)) if len(ids) else np.arange(0)
    while len(going):
        i = np.minimum(np.searchsorted(ids, at[going]), len(ids) - 1)
        inner = (ids[i] == at[going]) & (feature[i] >= 0)
        going, i = going[inner], i[inner]
        at[going] = 2 * at[going] + (x[going, feature[i]] > cut[i])
    return at


def grow(tree: int, top: int, x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, picks: int, seed: int) -> pa.Table:
    """All nodes below and with ``top``, split until labels or features are the same or the depth is reached."""
    at, level = np.full(len(y), top, np.int64), int(top).bit_length() - 1
    out: list[tuple[np.ndarray, ...]] = []
    labels: list[list[int]] = []
    shares: list[list[float]] = []
    while len(y):
        order = np.argsort(at, kind="stable")
        at, x, y, w = at[order], x[order], y[order], w[order]
        nodes, first, node = np.unique(at, return_index=True, return_inverse=True)
        varied = np.minimum.reduceat(x, first) != np.maximum.reduceat(x, first)
        split = (np.minimum.reduceat(y, first) != np.maximum.reduceat(y, first)) & varied.any(1) & (level < depth)
        chosen = _chosen(tree, nodes, varied, picks, seed) & split[:, None]
        best, feature, cut = np.full(len(nodes), np.inf), np.full(len(nodes), -1), np.full(len(nodes), -1)
        for f in range(x.shape[1]):
            use = chosen[node, f]
            if use.any():
                cost, where = best_cuts(node[use], x[use, f], y[use], w[use], len(nodes))
                better = cost < best
                best[better], feature[better], cut[better] = cost[better], f, where[better]
        stays = feature[node] < 0
        out.append((nodes, feature, cut))
        size = int(y.max()) + 1
        pairs, pair = np.unique(node[stays] * size + y[stays], return_inverse=True)
        weight = np.bincount(pair, w[stays], len(pairs))
        share = weight / np.bincount(pairs // size, weight, len(nodes))[pairs // size]
        ends = np.searchsorted(pairs // size, np.arange(len(nodes) + 1))
        names = pairs % size
        labels += [names[a:b].tolist() for a, b in zip(ends, ends[1:])]
        shares += [share[a:b].tolist() for a, b in zip(ends, ends[1:])]
        on = ~stays
        x, y, w, node, at = x[on], y[on], w[on], node[on], at[on]
        at = 2 * at + (x[np.arange(len(y)), feature[node]] > cut[node])
        level += 1
    ids, feature, cut = (np.concatenate(c) for c in zip(*out))
    n = len(ids)
    return pa.table([pa.array(np.full(n, tree, np.int32)), pa.array(np.full(n, top, np.int64)), pa.array(ids), pa.array(feature.astype(np.int32)), pa.array(cut.astype(np.int32)), pa.array(labels, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64()))], names=["tree", "top", "id", "feature", "cut", "labels", "shares"])


def _bins(column: pa.Array, n_features: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features).astype(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().astype(np.int32)))


def _drawn(batch: pa.RecordBatch, n_features: int, trees: int, top: Top, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each tree the cells of its bootstrap: node, bins, label and how often drawn."""
    x, (key, y, n) = _bins(batch.column("bins"), n_features), (batch.column(c).to_numpy() for c in ("key", "label", "n"))
    for tree in range(trees):
        u = _mix(key.view(_U) ^ _mix(np.full(len(key), (tree + 1) * 0x632BE5AB + seed, _U)))
        w = poisson(n, (u >> _U(11)).astype(np.float64) / (1 << 53))
        use = w > 0
        if use.any():
            at = np.ones(int(use.sum()), np.int64)
            yield tree, _walk(x[use], at, *top[tree]) if tree in top else at, x[use], y[use], w[use]


def _upper_levels(cells: DataFrame, levels: int, n_features: int, trees: int, picks: int, seed: int) -> Top:
    """Splits of the upper levels of all trees: a histogram of every node, and a group that decides for each."""
    top: Top = {}
    for level in range(levels):

        def count(batches: Iterator[pa.RecordBatch], top=top, level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, at, x, y, w in _drawn(batch, n_features, trees, top, seed):
                    here = at >> level == 1  # a node further up is a leaf
                    if here.any():
                        bins, labels = int(x.max()) + 1, int(y.max()) + 1
                        code = (((at[here, None] * n_features + np.arange(n_features)) * bins + x[here]) * labels + y[here, None]).ravel()
                        kinds, kind = np.unique(code, return_inverse=True)
                        total = np.bincount(kind, np.repeat(w[here], n_features), len(kinds)).astype(np.int64)
                        rest, label = np.divmod(kinds, labels)
                        rest, bin = np.divmod(rest, bins)
                        node, feature = np.divmod(rest, n_features)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), tree, np.int32)), *map(pa.array, (node, feature, bin, label, total))], names=["tree", "node", "feature", "bin", "label", "w"])

        def decide(table: pa.Table) -> pa.Table:
            tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            feature, bin, label, w = (table.column(c).to_numpy() for c in ("feature", "bin", "label", "w"))
            varied = np.array([[len(np.unique(bin[feature == f])) > 1 for f in range(n_features)]])
            found = (np.inf, -1, -1)
            if len(np.unique(label)) > 1:
                for f in np.flatnonzero(_chosen(tree, np.array([node]), varied, picks, seed)[0]).tolist():
                    use = feature == f
                    cost, cut = best_cuts(np.zeros(use.sum(), np.int64), bin[use], label[use], w[use], 1)
                    found = min(found, (float(cost[0]), f, int(cut[0])))
            return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), "feature": pa.array([found[1]], pa.int32()), "cut": pa.array([found[2]], pa.int32())})

        each = cells.mapInArrow(count, "tree int, node long, feature long, bin long, label long, w long")
        sums = each.groupBy("tree", "node", "feature", "bin", "label").agg(F.sum("w").alias("w"))
        splits = sums.groupBy("tree", "node").applyInArrow(decide, "tree int, node long, feature int, cut int").where("feature >= 0").collect()  # 2 ** level for each tree at most
        top = dict(top)
        for tree in {r["tree"] for r in splits}:
            new = sorted((r["node"], r["feature"], r["cut"]) for r in splits if r["tree"] == tree)
            old = list(zip(*(c.tolist() for c in top[tree]))) if tree in top else []
            top[tree] = tuple(np.array(c, np.int64) for c in zip(*sorted([*old, *new])))
    return top


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def _dealt(rows: DataFrame, groups: int) -> DataFrame:
    """Rows by tree and upper node; a number of partitions of our own, since a few rows may be much work."""
    return rows.repartition(max(1, min(groups, _tasks(rows.sparkSession))), "tree", "top")


def fit_forest(rows: DataFrame, trees: int = 100, depth: int = 30, bins: int = 32, seed: int = 42, weight: str | None = None, group_cells: int = GROUP_CELLS) -> "DeepForestModel":
    """Trees over bootstraps of rows with features and label (a number from 0), and a whole weight if they stand for several.

    A node tries the square root of the number of features, of those that vary
    in it, and is split while its labels differ, as deep as ``depth``.
    """
    spark = rows.sparkSession
    each = rows.select("features", F.col("label").cast("long").alias("label"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("n")).where("label IS NOT NULL")
    limits = bin_limits(each, "features", bins, each if weight is None else each.select("features", F.explode(F.sequence(F.lit(1).cast("long"), "n"))))
    binned = each.select(bins_of(vector_to_array("features"), limits).alias("bins"), "label", "n").groupBy("bins", "label").agg(F.sum("n").alias("n"))
    cells = materialize(binned.withColumn("key", F.xxhash64("bins", "label")).repartition(_tasks(spark), "key"))  # a small table, and much work with each row
    n, most = cells.agg(F.count(F.lit(1)), F.max("label")).first()
    depth, n_features, picks = min(depth, MOST_DEPTH), len(limits), max(1, math.isqrt(len(limits)))
    levels = min(depth, max(0, math.ceil(math.log2(max(1, n) / group_cells))))
    top = _upper_levels(cells, levels, n_features, trees, picks, seed)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, at, x, y, w in _drawn(batch, n_features, trees, top, seed):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), tree, np.int32)), pa.array(at), _lists(x), pa.array(y), pa.array(w)], names=["tree", "top", "bins", "label", "w"])

    def grown(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = _bins(table.column("bins").chunk(0), n_features)
        return grow(table.column("tree")[0].as_py(), table.column("top")[0].as_py(), x, table.column("label").to_numpy(), table.column("w").to_numpy(), depth, picks, seed)

    drawn = _dealt(cells.mapInArrow(draw, "tree int, top long, bins array<int>, label long, w long"), trees << levels)
    nodes = materialize(drawn.groupBy("tree", "top").applyInArrow(grown, _NODES))
    return DeepForestModel(nodes, {t: [c.tolist() for c in v] for t, v in top.items()}, limits, (most or 0) + 1, trees, levels)


class _Writer(MLWriter):
    def __init__(self, model: "DeepForestModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        facts = {"top": {str(t): v for t, v in m.top.items()}, "limits": m.limits, "classes": m.classes, "trees": m.trees, "levels": m.levels}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=facts)
        m.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> "DeepForestModel":
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.schema(_NODES).parquet(f"{path}/nodes")
        model = DeepForestModel(nodes, {int(t): v for t, v in facts["top"].items()}, facts["limits"], facts["classes"], facts["trees"], facts["levels"])
        model._resetUid(facts["uid"])
        DefaultParamsReader.getAndSetParams(model, facts)
        return model


class DeepForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, MLWritable, MLReadable):
    """Mean of the shares of labels in the leaves of all trees as ``probability``; the first of the largest is the prediction.

    Rows with equal bins are scored once, by the groups of nodes they come to.
    """

    def __init__(self, nodes: DataFrame | None = None, top: dict[int, list] | None = None, limits: list[list[float]] | None = None, classes: int = 1, trees: int = 0, levels: int = 0):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self.nodes, self.top, self.limits, self.classes, self.trees, self.levels = nodes, top or {}, limits or [], classes, trees, levels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, n_features = self.trees, len(self.limits)
        top: Top = {t: tuple(np.array(c, np.int64) for c in v) for t, v in self.top.items()}
        rows = dataset.withColumn("__bins", bins_of(vector_to_array(self.getFeaturesCol()), self.limits))
        kinds = materialize(rows.select("__bins").distinct().repartition(_tasks(dataset.sparkSession), "__bins").withColumn("__kind", F.monotonically_increasing_id()))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, start = _bins(batch.column("__bins"), n_features), np.ones(batch.num_rows, np.int64)
                for tree in range(trees):
                    at = _walk(x, start, *top[tree]) if tree in top else start
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), tree, np.int32)), pa.array(at), batch.column("__kind"), batch.column("__bins")], names=["tree", "top", "kind", "bins"])

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            left, right = left.combine_chunks().sort_by("id"), right.combine_chunks()
            kind, labels, shares = pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.float64())
            if len(left) and len(right):
                ids, feature, cut = (left.column(c).to_numpy() for c in ("id", "feature", "cut"))
                end = _walk(_bins(right.column("bins").chunk(0), n_features), right.column("top").to_numpy(), ids, feature, cut)
                leaf = left.take(pa.array(np.searchsorted(ids, end))).combine_chunks()
                lists = leaf.column("labels").chunk(0)
                kind = pa.array(np.repeat(right.column("kind").to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False)))
                labels, shares = lists.flatten(), leaf.column("shares").chunk(0).flatten()
            return pa.table([kind, labels, shares], names=["kind", "label", "share"])

        asked = _dealt(kinds.mapInArrow(send, "tree int, top long, kind long, bins array<int>"), trees << self.levels)
        nodes = _dealt(self.nodes, trees << self.levels)
        votes = nodes.groupBy("tree", "top").cogroup(asked.groupBy("tree", "top")).applyInArrow(meet, "kind long, label int, share double")
        sums = votes.groupBy("kind", "label").agg(F.round(F.sum("share"), 9).alias("share"))
        each = sums.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("label", "share"))).alias("of"), F.sum("share").alias("all"))
        mean = F.transform(F.sequence(F.lit(0), F.lit(self.classes - 1)), lambda i: F.coalesce(F.get(F.map_values(F.map_filter("of", lambda k, _: k == i)), F.lit(0)), F.lit(0.0)) / F.round("all", 6))
        known = materialize(kinds.join(each, kinds["__kind"] == each["kind"]).select("__bins", mean.alias("__shares")))
        out = rows.join(known, "__bins", "left").withColumn("__shares", F.coalesce("__shares", F.array_repeat(F.lit(0.0), self.classes)))
        best = (F.array_position("__shares", F.array_max("__shares")) - 1).cast("double")
        out = out.withColumn(self.getPredictionCol(), best).withColumn(self.getProbabilityCol(), array_to_vector("__shares"))
        return out.select(*dataset.columns, self.getPredictionCol(), self.getProbabilityCol())

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()
