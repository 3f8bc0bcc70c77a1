import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quorumkit.functions import sequence as S
from quorumkit.operators import abundance as A
from quorumkit.operators import allocate, features, metrics, registry, reprofile, sequences, synth, taxonomy


def table(spark, rows, names="annotator, sample, taxid, n"):
    return spark.createDataFrame(rows, names.replace(" ", "").split(","))


@pytest.fixture(scope="module")
def toy(spark):
    return table(spark, [("k", "s1", "a", 3), ("k", "s1", "b", 3), ("k", "s1", "c", 1), ("k", "s2", "a", 10), ("k", "s2", "d", 0)])


def test_scaling_to_an_exact_total(toy):
    got = {(r["sample"], r["taxid"]): r["n"] for r in A.scale_exact(toy, 10).collect()}
    assert sum(v for (s, _), v in got.items() if s == "s1") == 10
    assert got["s1", "a"] == 5 and got["s1", "b"] == 4 and got["s1", "c"] == 1  # the residual goes to the first of the largest
    assert A.drop_zero_labels(toy).where("taxid = 'd'").count() == 0


def test_filter_falls_back_to_all_that_is_not_zero(toy):
    assert {r["taxid"] for r in A.filter_labels(toy, 0.4).select("taxid").distinct().collect()} == {"a", "b"}
    assert {r["taxid"] for r in A.filter_labels(toy, 2.0).select("taxid").distinct().collect()} == {"a", "b", "c"}
    assert A.filter_labels(toy, 2.0, 100, rescale=True).count() == 0


def brute_allocation(avail, reqs):
    total, left, out = sum(reqs), avail, []
    for i, r in enumerate(reqs):
        if not total:
            n = avail // len(reqs) + (i < avail % len(reqs))
        else:
            n = left if i == len(reqs) - 1 else min(left, round(r / total * avail))
        out.append(n)
        left -= n
    return out


def test_allocation_against_a_loop(spark):
    rng = random.Random(1)
    cases = [(i, rng.randint(0, 40), [rng.choice([0, 0, 1, 2, 5, 9]) for _ in range(rng.randint(1, 6))]) for i in range(300)]
    req = spark.createDataFrame([(i, f"s{p}", p, r) for i, _, rs in cases for p, r in enumerate(rs)], ["case", "sample", "pos", "req"])
    av = spark.createDataFrame([(i, a) for i, a, _ in cases], ["case", "avail"])
    got = {(r["case"], r["pos"]): r["n"] for r in allocate.allocate(req, av, ["case"]).collect()}
    for i, a, rs in cases:
        assert [got[i, p] for p in range(len(rs))] == brute_allocation(a, rs)


def test_split_pool_keeps_composition(spark):
    pool = spark.createDataFrame([("562", i) for i in range(6)] + [("9606", i) for i in range(4)], ["source", "item"])
    req = spark.createDataFrame([("s1", 0, "562", 4), ("s1", 0, "9606", 1), ("s2", 1, "562", 2), ("s2", 1, "9606", 3)], ["sample", "pos", "source", "req"])
    got = {(r["sample"], r["source"]): r["n"] for r in allocate.split_pool(pool, req, ["source"], ["item"]).groupBy("sample", "source").agg(F.count("*").alias("n")).collect()}
    assert got == {("s1", "562"): 4, ("s1", "9606"): 1, ("s2", "562"): 2, ("s2", "9606"): 3}


def test_sample_design_totals(spark):
    genomes = spark.createDataFrame([("5",), ("6",), ("7",)], ["taxid"])
    sums = allocate.sample_design(spark, 4, 100, genomes, 0.25).groupBy("sample").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    assert [(r["n"], r["k"]) for r in sums] == [(100, 4)] * 4


def test_metrics_on_small_counts(spark):
    votes = spark.createDataFrame([("s", str(i), t, "k", p) for i, (t, p) in enumerate([("1", "1"), ("1", "2"), ("2", "2"), ("2", "9"), ("2", "0")])], ["sample", "seq", "true", "annotator", "label"])
    counts = metrics.confusion(metrics.collapse_other(votes))
    assert {(r["true"], r["pred"], r["freq"]) for r in counts.collect()} == {("1", "1", 1), ("1", "2", 1), ("2", "2", 1), ("2", "other", 1), ("2", "0", 1)}
    assert metrics.f1_scores(counts).first()["f1"] == pytest.approx(0.4)
    assert metrics.r2_scores(counts).first()["r2"] == pytest.approx(1 - (1 + 1) / 0.5)
    order = metrics.label_order(spark.createDataFrame([("1", "1", 5), ("1", "2", 2), ("2", "2", 1), ("0", "1", 9)], ["a", "b", "freq"]))
    places = {r["label"]: r["place"] for r in order.collect()}
    assert sorted(places.values()) == [1, 2, 3] and places["0"] == 3


def entropy(p):
    return -sum(x * math.log2(x + 1e-12) for x in p)


def test_sequence_features_against_python(spark):
    rng = random.Random(3)
    seqs = ["", "A", "ACG", "AAAAAAAAAAAA", *("".join(rng.choice("ACGTN") for _ in range(rng.randint(5, 80))) for _ in range(20))]
    df = spark.createDataFrame(list(enumerate(seqs)), "read_id int, seq string")
    got = {r["read_id"]: r for r in sequences.read_features(df).collect()}
    for i, s in enumerate(seqs):
        r, n = got[i], len(s)
        p = [s.count(c) / n for c in set(s)] if n else []
        assert r["gc"] == (pytest.approx((s.count("G") + s.count("C")) / n) if n else None)
        assert r["shannon"] == pytest.approx(entropy(p), abs=1e-9)
        tri = [s[j : j + 3] for j in range(n - 2)]
        assert r["ling_complexity"] == pytest.approx(len(set(tri)) / min(64, n - 2) if tri else 0)
        assert r["dust"] == pytest.approx(sum(sum(t.count(c) * (t.count(c) - 1) for c in set(t)) for t in tri) / n if n else 0)
        ten = [s[j : j + 10] for j in range(n - 9)]
        assert r["repeat_frac"] == pytest.approx(sum(len(set(t)) < 5 for t in ten) / len(ten) if ten else 0)


def test_translation_parts_and_mutation(spark):
    one = lambda v, f: spark.createDataFrame([(v,)], ["s"]).select(f(F.col("s"))).first()[0]
    assert one("AUGGAATTCTAANNNTT", S.translate) == "MEF*X"
    assert one("", S.translate) == "" and one("AACG", S.reverse_complement) == "CGTT"
    assert one("ATCGATCG", lambda c: S.parts(c, 50)) == ["ATCG", "ATCG"] and one("ATC", lambda c: S.parts(c, 1)) == ["ATC"]
    s = "ACGT" * 50
    assert one(s, lambda c: S.mutate(c, F.lit("k"), 0.0, 1)) == s
    whole = one(s, lambda c: S.mutate(c, F.lit("k"), 1.0, 1))
    assert sum(a != b for a, b in zip(s, whole)) == 1
    some = one(s, lambda c: S.mutate(c, F.lit("k"), 0.2, 1))
    assert 0 < sum(a != b for a, b in zip(s, some)) < 90 and len(some) == len(s)
    contigs = spark.createDataFrame([("f", "5", 0, "h", "ACGT"), ("f", "5", 1, "h", "GG")], ["file", "taxid", "contig_no", "header", "sequence"])
    assert sequences.join_contigs(contigs, spacer=3).first()["sequence"] == "ACGTNNNGG"
    lib = sequences.protein_library(spark.createDataFrame([("5",), ("6",)], ["taxid"]), spark.createDataFrame([("5", "p", "MM")], ["taxid", "id", "aa"]), spark.createDataFrame([("5", "f", "A"), ("6", "f", "B")], ["taxid", "id", "aa"]))
    assert {tuple(r) for r in lib.collect()} == {("5", "p", "MM"), ("6", "f", "B")}


def test_kmer_profiles_leave_out_other_letters(spark):
    v = features.kmer_profiles(spark.createDataFrame([("ACNAC",), ("",)], ["seq"]), 2).collect()
    assert v[0]["kmers"][1] == pytest.approx(1.0) and sum(v[1]["kmers"].toArray()) == 0
    rows = [(c, "".join(random.Random(i).choices("AC" if c == "x" else "GT", k=60))) for i, c in enumerate("xy" * 10)]
    p = features.kmer_profiles(spark.createDataFrame(rows, ["cls", "seq"]), 2)
    out = features.classify_composition(features.fit_composition_classifier(p, "cls", 2, (8,), steps=30), p)
    assert out.where("pred = cls").count() == 20
    assert set(features.composition_features(None, p).columns) >= {"kmer_pca_1", "tetrabin"}


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        t = rng.choice(["7", "8", "9"])
        rows.append(("s", f"r{i}", t if rng.random() < 0.9 else "0", t if rng.random() < 0.6 else "8", str(100 + i % 3), t))
    return spark.createDataFrame(rows, ["sample", "seq", "taxid_a", "taxid_b", "length", "true"])


def test_reprofiler_learns_and_overrides(spark, training):
    model = reprofile.train(training, trees=8, rounds=6)
    assert max(model.accuracy.values()) > 0.8 and model.features == ["length", "taxid_a", "taxid_b"]
    votes = spark.createDataFrame([("s", "x", "7", "7", "100"), ("s", "y", "0", "0", "100"), ("s", "z", "9", "0", "100"), ("s", "w", "7", "8", "100")], ["sample", "seq", "taxid_a", "taxid_b", "length"])
    got = {r["seq"]: (r["corrected"], r["corrected_confidence"]) for r in reprofile.apply_reprofiler(votes, model).collect()}
    assert got["x"] == ("7", 1.0) and got["y"] == ("0", 0.0) and got["z"][0] == "9" and 0 < got["w"][1] <= 1
    assert reprofile.train(training.where("false")) is None


def test_boosting_separates_three_classes(spark, training):
    ready = reprofile.assemble(training, ["taxid_a", "taxid_b"]).withColumn("label", (F.col("true").cast("int") - 7).cast("double"))
    boosted = reprofile.fit_boosted(ready, rounds=12)
    got = boosted.transform(ready)
    assert got.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.85
    assert got.where(F.abs(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b) - 1) > 1e-9).count() == 0


def test_split_is_stratified_and_stable(spark, training):
    a = reprofile.stratified_split(training)
    b = reprofile.stratified_split(training.repartition(7))
    assert {r["seq"] for r in a.where("is_test").collect()} == {r["seq"] for r in b.where("is_test").collect()}
    shares = a.groupBy("true").agg(F.avg(F.col("is_test").cast("double")).alias("x")).collect()
    assert all(abs(r["x"] - 0.2) < 0.03 for r in shares)


def test_roc(spark):
    points = spark.createDataFrame([(0.9, 1.0), (0.8, 1.0), (0.3, 0.0), (0.1, 0.0)], ["score", "label"])
    assert reprofile.micro_auc(points) == pytest.approx(1.0)
    assert [(r["fpr"], r["tpr"]) for r in reprofile.roc_curve(points).orderBy(F.desc("score")).collect()][-1] == (1.0, 1.0)


@pytest.fixture(scope="module")
def profile(spark):
    rng = np.random.default_rng(5)
    rows = [("k", f"s{s}", f"t{t}", int(rng.poisson(20 * (t + 1) * (1 + s % 2)))) for s in range(6) for t in range(8)]
    return table(spark, rows)


@pytest.mark.parametrize("mode", ["direct", "bootstrap", "vae", "glm"])
def test_synthetic_profiles(profile, mode):
    got = synth.regenerate(profile, mode, n_samples=8, n_reads=500, rescale=True)
    again = synth.regenerate(profile.repartition(5), mode, n_samples=8, n_reads=500, rescale=True)
    a, b = (sorted((r["sample"], r["taxid"], r["n"]) for r in x.collect()) for x in (got, again))
    assert a == b and all(n >= 0 for _, _, n in a)
    totals = {}
    for s, _, n in a:
        totals[s] = totals.get(s, 0) + n
    assert set(totals.values()) <= {500, 0}
    assert set(totals) == {f"s{i}" for i in range(6)} | (set() if mode == "direct" else {"s0_r2", "s1_r2"})


def test_cluster_sizes_and_modes():
    corr = np.eye(7) + 0.9 * (np.add.outer(np.arange(7), np.arange(7)) % 2 == 0)
    assert len(set(synth.cluster_labels(corr, 2, 100))) == 3
    assert synth.normalize_mode("Preserve") == "direct" and synth.settings(treshhold_amount=3)["threshold"] == 3
    with pytest.raises(ValueError):
        synth.normalize_mode("magic")


def test_registry(spark):
    reads = spark.createDataFrame([("r1", "ACGT"), ("r1", "AC"), ("r2", "GG")], ["read_id", "seq"])
    registry.register("long", registry.from_model(lambda f: (f["seq"].str.len() > 2).astype(int)))
    out = registry.annotate(reads, ["constant9606", "long"])
    assert out.where("tool = 'constant9606'").count() == 2 and out.where("tool = 'long' AND taxid = '1'").count() == 1


def test_saved_models_of_both_kinds_give_the_same_labels(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{i}", str(100 + i % 3), str(100 + (i % 3 if i % 5 else (i + 1) % 3)), "50", str(100 + i % 3)) for i in range(240)], "seq string, taxID_a_0 string, taxID_b_0 string, length string, true string")
    forest = reprofile.train(rows, trees=5, rounds=3)
    boosted = reprofile.Reprofiler("AdaBoost", reprofile.fit_boosted(forest.labels.transform(reprofile.assemble(rows, forest.features)), 3), forest.labels, forest.features, {})
    for name, model in (("forest", forest), ("boosted", boosted)):
        reprofile.save_model(model, str(tmp_path / name))
        again = reprofile.load_model(spark, str(tmp_path / name))
        wanted = sorted(map(tuple, reprofile.apply_reprofiler(rows, model).select("seq", "corrected", "corrected_confidence").collect()))
        assert sorted(map(tuple, reprofile.apply_reprofiler(rows, again).select("seq", "corrected", "corrected_confidence").collect())) == wanted


def test_a_folder_of_votes_is_reprofiled(spark, tmp_path):
    for name in ("s1", "s2"):
        lines = ["seq,taxID_a_0,taxID_b_0,length,true", *(f"r{i},{100 + i % 2},{100 + i % 2},50,{100 + i % 2}" for i in range(60)), "u1,0,0,50,100"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines))
    files = [str(tmp_path / f"{n}.csv") for n in ("s1", "s2")]
    out = reprofile.reprofile_directory(spark, files, files, str(tmp_path / "out"), trees=3, rounds=2)
    assert sorted(p.name for p in (tmp_path / "out").glob("*.csv")) == ["s1_reprofiled.csv", "s2_reprofiled.csv"]
    got = {(r["sample"], r["seq"]): r["corrected"] for r in out.collect()}
    assert got["s1", "r3"] == "101" and got["s2", "u1"] == "0" and len(got) == 122
    assert reprofile.reprofile_directory(spark, [], files, str(tmp_path / "none")) is None and not (tmp_path / "none").exists()


def test_deep_trees_and_cycles(spark):
    deep = [(i, max(1, i - 1), "species" if i == 300 else "genus" if i == 5 else "none") for i in range(1, 302)]
    nodes = spark.createDataFrame(deep, "tax_id long, parent long, rank string")
    found = {r["tax_id"]: r["ancestor"] for r in taxonomy.ancestor_at_rank(nodes, "genus").collect()}
    assert found == {i: 5 for i in range(5, 302)}
    lines = {r["tax_id"]: r["lineage"] for r in taxonomy.lineage(nodes, nodes.where("tax_id IN (301, 4)")).collect()}
    assert lines[301] == {"species": 300, "genus": 5, "none": 2} and lines[4] == {"none": 2}
    assert {(r["at_rank"], r["tax_id"]) for r in taxonomy.ancestors_at_ranks(nodes, ["species", "genus"], nodes.where("tax_id = 301")).collect()} == {("species", 301), ("genus", 301)}
    loop = spark.createDataFrame([(2, 3, "none"), (3, 5, "none"), (5, 2, "none"), (4, 3, "none")], "tax_id long, parent long, rank string")
    for walk in (lambda: taxonomy.ancestor_at_rank(loop, "genus"), lambda: taxonomy.lineage(loop, loop)):
        with pytest.raises(ValueError):
            walk()
