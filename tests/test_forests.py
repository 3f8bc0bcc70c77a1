"""Forests and clusters as joins against plain loops."""

import numpy as np
import pytest

from quorumkit.operators import forests, synth


def kruskal(edges):
    best = {}
    for g, a, b, w in edges:
        if a != b and w is not None:
            key = (g, min(a, b), max(a, b))
            best[key] = max(w, best.get(key, -np.inf))
    own, out = {}, set()

    def find(x):
        while own.setdefault(x, x) != x:
            x = own[x]
        return x

    for (g, a, b), w in sorted(best.items(), key=lambda e: (-e[1], e[0][1], e[0][2])):
        x, y = find((g, a)), find((g, b))
        if x != y:
            own[x] = y
            out.add((g, a, b, w))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_forest_equals_kruskal(spark, seed):
    r = np.random.default_rng(seed)
    edges = [(f"g{r.integers(0, 3)}", f"n{r.integers(0, 40):02}", f"n{r.integers(0, 40):02}", float(r.integers(0, 6)) if r.random() < 0.95 else None) for _ in range(260)]
    edges += [("line", f"p{i:03}", f"p{i + 1:03}", float(i % 7)) for i in range(70)]
    frame = spark.createDataFrame(edges, "g string, a string, b string, w double").repartition(5)
    got = [tuple(x) for x in forests.spanning_forest(frame).select("g", "a", "b", "w").collect()]
    assert len(got) == len(set(got)) and set(got) == kruskal(edges)


def test_forest_of_nothing(spark):
    assert forests.spanning_forest(spark.createDataFrame([("g", "a", "a", 1.0)], "g string, a string, b string, w double")).collect() == []


@pytest.mark.parametrize("n,min_size,max_size", [(24, 2, 100), (24, 8, 4), (9, 100, 100), (2, 1, 1)])
def test_clusters_equal_the_loop(spark, n, min_size, max_size):
    r = np.random.default_rng(n)
    corr = np.corrcoef(r.normal(size=(n, 6)))
    names = [f"t{i:02}" for i in range(n)]
    nodes = spark.createDataFrame([("g", x) for x in names] + [("h", "alone")], "g string, node string")
    pairs = spark.createDataFrame([("g", names[j], names[i], float(1 - abs(corr[i, j]))) for i in range(n) for j in range(i + 1, n)], "g string, a string, b string, d double")
    got = {(x["g"], x["node"]): x["cluster"] for x in forests.average_linkage(nodes, pairs, min_size, max_size).collect()}
    own = synth.cluster_labels(corr, min_size, max_size)
    want = {("g", names[i]): names[int(np.flatnonzero(own == own[i])[0])] for i in range(n)} | {("h", "alone"): "alone"}
    assert got == want
