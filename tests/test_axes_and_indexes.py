"""Label order, exact quantiles and areas, the substring index, emitters and mutation against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumkit.functions import sequence as S
from quorumkit.operators import metrics, registry, reprofile, sequences


def order_by_numpy(counts):
    names = sorted({x for k in counts for x in k} - {"0", "other"})
    m = np.zeros((len(names),) * 2)
    for (a, b), f in counts.items():
        if a in names and b in names:
            m[names.index(a), names.index(b)] += f
    both = m + m.T
    np.fill_diagonal(both, np.diag(m))
    c = both - both.mean(0)
    score = c @ np.linalg.svd(c)[2][0]
    score *= np.sign(score[np.argmax(np.abs(score))])
    return [names[i] for i in np.argsort(score, kind="stable")]


def confusion_like(n, seed):
    rng = np.random.default_rng(seed)
    counts = {}
    for i in range(n):
        for j in rng.choice(n, 6):
            counts[f"t{i:03}", f"t{j:03}"] = counts.get((f"t{i:03}", f"t{j:03}"), 0) + int(rng.integers(1, 40))
        counts[f"t{i:03}", f"t{i:03}"] = 100 + int(5000 * 0.8**i)
        counts[f"t{i:03}", "0"] = 5
    counts["other", "t000"] = 3
    return counts


def ordered(spark, counts):
    frame = spark.createDataFrame([(a, b, f) for (a, b), f in counts.items()], "a string, b string, freq long")
    return [r["label"] for r in metrics.label_order(frame).orderBy("place").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_label_order_equals_numpy(spark, seed):
    for n in (3, 6, 60):
        counts = confusion_like(n, seed)
        assert ordered(spark, counts) == order_by_numpy(counts) + ["0", "other"]


def test_distributed_label_order_equals_numpy(spark, monkeypatch):
    """The same order from joins alone, for 5 labels and for 180, more than are ever solved at once."""
    small = confusion_like(5, 5)
    monkeypatch.setattr(metrics, "SMALL_MATRIX", 0)
    assert ordered(spark, small) == order_by_numpy(small) + ["0", "other"]
    monkeypatch.undo()
    large = confusion_like(180, 6)
    assert ordered(spark, large) == order_by_numpy(large) + ["0", "other"]


def test_label_order_without_an_axis(spark):
    assert ordered(spark, {("b", "a"): 2, ("a", "a"): 2, ("b", "b"): 2, ("0", "a"): 1}) == ["a", "b", "0"]
    assert ordered(spark, {("a", "0"): 2}) == ["a", "0"]
    assert ordered(spark, {}) == []


def test_quantiles_are_exact(spark):
    rng = random.Random(3)
    rows = [(lab, None if rng.random() < 0.1 else rng.choice([rng.random(), 0.5])) for lab in ["a"] * 301 + ["b"] * 40 + [None] * 7 + ["c"] * 2] + [("d", None)] * 3
    frame = spark.createDataFrame(rows, "label string, conf double")
    got = {r["label"]: tuple(r)[1:] for r in metrics.confidence_summary(frame, "label", "conf", 0).collect()}
    for lab in ("a", "b", None, "c"):
        v = [c for x, c in rows if x == lab and c is not None]
        assert got[lab][0] == sum(x == lab for x, _ in rows)
        assert np.allclose(got[lab][1:], np.quantile(v, [0, 0.25, 0.5, 0.75, 1]) if v else [np.nan] * 5)
    assert got["d"] == (3, None, None, None, None, None)
    assert [r["label"] for r in metrics.confidence_summary(frame, "label", "conf", 2).collect()] == ["a", "b"]


def test_areas_count_ties_half(spark):
    rng = random.Random(4)
    points = [(rng.choice([0.1, 0.2, 0.3, rng.random()]), float(rng.random() < 0.4)) for _ in range(300)]
    frame = spark.createDataFrame(points, "score double, label double").repartition(5)
    pos, neg = [s for s, y in points if y], [s for s, y in points if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(reprofile.micro_auc(frame), want)
    curve = reprofile.roc_curve(frame).orderBy(F.desc("score")).collect()
    assert [r["score"] for r in curve] == sorted({s for s, _ in points}, reverse=True)
    for r in curve:
        assert math.isclose(r["tpr"], sum(p >= r["score"] for p in pos) / len(pos)) and math.isclose(r["fpr"], sum(n >= r["score"] for n in neg) / len(neg))
    assert reprofile.micro_auc(frame.where("label = 1")) is None


def test_substring_index_equals_nested_loops(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abé|", k=rng.randint(0, 9))) for _ in range(120)]
    parts = ["".join(rng.choices("abé|", k=rng.randint(0, 6))) for _ in range(60)] + [None]
    texts = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "t string, n int")
    wanted = spark.createDataFrame([(p, i) for i, p in enumerate(parts)], "p string, k int")
    found = sequences.containing(wanted, "p", texts, "t")
    assert found.columns == ["p", "k", "t", "n"]
    assert sorted((r["k"], r["n"]) for r in found.collect()) == sorted((k, n) for k, p in enumerate(parts) if p for n, w in enumerate(words) if p in w)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert sequences.containing(wanted.where("p IS NULL"), "p", texts, "t").count() == 0


def test_first_of_several_containing_contigs(spark):
    contigs = spark.createDataFrame([("zz_c7_x", 4, "ATGAAATAA"), ("aa_c7_y more", 2, "ATGCCCTAA"), ("c77", 9, "ATGGGGTAA"), ("c8", 1, "ATGTTTTAA")], "header string, contig_no int, sequence string")
    gff = spark.createDataFrame([(seqid, "CDS", 1, 9, "+", 0, {"ID": f"p{i}"}) for i, seqid in enumerate(["c7_", "7", "c8", "none"])], "seqid string, type string, start long, end long, strand string, phase int, attrs map<string,string>")
    got = {r["protein_id"]: r["aa"] for r in sequences.coding_sequences(gff, contigs, min_aa=1).collect()}
    assert got == {"p0": "MP", "p1": "MP", "p2": "MF"}


class Windows:
    """Every row with the one before it in its partition."""

    def __init__(self):
        self.last, self.n = None, 0

    def rows(self, row):
        self.n += 1
        if self.last is not None:
            yield self.last, row["v"]
        self.last = row["v"]

    def finish(self):
        yield self.n, None


def test_emitters_see_partitions_in_order(spark):
    registry.register_emitter(spark, "pairs_of", Windows, "before int, now int")
    spark.createDataFrame([("a", 3), ("a", 1), ("b", 5), ("a", 2), (None, 9)], "k string, v int").createOrReplaceTempView("emitter_rows")
    got = spark.sql("SELECT * FROM pairs_of(TABLE(emitter_rows) PARTITION BY k ORDER BY (v), 'k')")
    assert got.columns == ["k", "before", "now"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", 1, 2), ("a", 2, 3), ("a", 3, None), ("b", 1, None), (None, 1, None)]))
    assert spark.sql("SELECT * FROM pairs_of(TABLE(SELECT * FROM emitter_rows WHERE false) PARTITION BY k)").collect() == []


def test_mutations_have_their_rate_and_stay_put(spark):
    text = "ACGTacgtNN" * 2000
    frame = spark.createDataFrame([(text, "k1"), (text, "k2"), ("", "e"), (None, "n"), ("ACGT", None)], "s string, k string")
    got = [r[0] for r in frame.select(S.mutate(F.col("s"), F.col("k"), 0.1, 7)).collect()]
    assert got == [r[0] for r in frame.repartition(3).select("k", S.mutate(F.col("s"), F.col("k"), 0.1, 7).alias("m"), "s").orderBy(F.expr("array_position(array('k1','k2','e','n'), coalesce(k, 'n'))"), F.col("k").isNull()).select("m").collect()]
    for new in got[:2]:
        changed = [i for i, (a, b) in enumerate(zip(text, new)) if a != b]
        assert len(new) == len(text) and 0.09 < len(changed) / len(text) < 0.11
        assert all(new[i] in "ACGT" and new[i] != text[i].upper() for i in changed)
    assert got[0] != got[1] and got[2:4] == ["", None]
    one = frame.limit(1).select(S.mutate(F.col("s"), F.col("k"), 1.0, 7)).first()[0]
    assert sum(a != b for a, b in zip(text, one)) == 1
