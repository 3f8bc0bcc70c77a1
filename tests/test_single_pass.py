"""What is read several times is computed once, and votes are counted before they meet other tables."""

import random
import re
import time
import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quorumkit.operators import boosting, metrics, reprofile
from quorumkit.plans import catalogue, files
from quorumkit.operators.boosting import StumpBooster, bin_limits, cells_of
from quorumkit.sinks.shared import LEAN_WRITES, settings


def counted(spark, column):
    """The column, and how many rows it was computed for so far."""
    seen = spark.sparkContext.accumulator(0)

    def same(v):
        seen.add(1)
        return v

    return F.udf(same, "double")(column), seen


def test_order_of_labels_reads_its_pairs_once(spark):
    pairs = spark.createDataFrame([("1", "1", 5.0), ("1", "2", 2.0), ("2", "2", 1.0), ("0", "1", 9.0)], "a string, b string, freq double")
    freq, seen = counted(spark, F.col("freq"))
    order = metrics.label_order(pairs.select("a", "b", freq.cast("long").alias("freq"))).collect()
    assert {r["label"] for r in order} == {"0", "1", "2"} and seen.value == 4


def test_pairs_of_annotators_of_repeated_reads(spark):
    wide = spark.createDataFrame([("s", "r1", "1", "2", None), ("s", "r1", "1", "3", "4"), ("s", "r2", "1", "2", "0"), (None, "r2", "1", "1", "1"), ("t", None, "1", "1", "1")], "sample string, seq string, x string, y string, z string")
    long = wide.unpivot(["sample", "seq"], ["x", "y", "z"], "annotator", "label")
    a, b = long.select("sample", "seq", F.col("annotator").alias("annotator_a"), F.col("label").alias("a")), long.select("sample", "seq", F.col("annotator").alias("annotator_b"), F.col("label").alias("b"))
    want = a.join(b, ["sample", "seq"]).where("annotator_a < annotator_b").groupBy("annotator_a", "annotator_b", "a", "b").agg(F.count(F.lit(1)).alias("freq"))
    for got in (metrics.cross_validation(long), metrics.cross_validation_of_reads(wide, ["x", "y", "z"])):
        assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(sample") == 1
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_boosting_reads_its_rows_once(spark):
    rows = spark.range(400).selectExpr("cast(id % 4 AS double) AS a", "cast(id % 3 AS double) AS b", "cast(id % 2 AS double) AS y")
    label, seen = counted(spark, F.col("y"))
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.select("a", "b", label.alias("label")))
    assert StumpBooster(rounds=2).fit(ready).stumps[0][0] == 0
    assert seen.value == 400
    cells = cells_of(ready, "features", "label")
    assert cells.count() == 12 and cells.agg(F.sum("n")).first()[0] == 400
    assert bin_limits(cells, "features", 2, ready) == bin_limits(ready, "features", 2)


def test_votes_are_counted_before_they_are_rolled_up(spark, data):
    for name in ("roll_up_to_genus", "votes_at_ranks"):
        plan = entry.queries()[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join LeftOuter") :]
        assert below.index("Aggregate") < below.index("Expand" if "Expand" in below else "Join Inner")


def test_the_reprofiler_reads_its_rows_once_and_weighs_cells(spark):
    rows = spark.range(300).selectExpr("cast(id AS string) AS seq", "cast(1 + id % 3 AS string) AS true", "cast(1 + id % 3 AS string) AS taxID_a_0", "cast(id % 2 AS double) AS x")
    x, seen = counted(spark, F.col("x"))
    model = reprofile.train(rows.withColumn("x", x), trees=3, rounds=3, depth=3)
    assert seen.value == 300 and model.accuracy["RandomForest"] == 1.0
    cells = spark.createDataFrame([(0.0, 0.0, 60), (1.0, 1.0, 30), (0.0, 1.0, 10)], "a double, label double, n long")
    each = cells.select("a", "label", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    ready = lambda df: VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    assert StumpBooster(rounds=3, weightCol="n").fit(ready(cells)).stumps == StumpBooster(rounds=3).fit(ready(each)).stumps


def test_sequences_are_derived_from_their_texts_once(spark, data):
    """The final plan starts from what was written, not from the documents."""
    for name in ("coding_proteins", "protein_library", "open_reading_frames"):
        assert "regexp_replace(text" not in entry.queries()[name](spark, data)._jdf.queryExecution().optimizedPlan().toString(), name


def test_texts_move_once_for_the_removal_of_repeats(spark):
    from quorumkit.llm import suffix_dedup

    docs = spark.createDataFrame([(1, "a" * 500), (2, "é" * 300 + "b"), (3, None)], "doc_id long, text string")
    out = suffix_dedup.remove_repeats(docs, 400)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join LeftOuter") :].splitlines()[1]
    assert "data#" not in below and "row#" in below
    assert [(r["doc_id"], r["n_bytes"]) for r in out.orderBy("doc_id").collect()] == [(1, 500), (2, 601), (3, 0)]


def test_best_stump_is_the_first_of_all_choices_in_few_jobs(spark):
    rng = random.Random(8)
    rows = [(f, b, float(y), rng.choice([0.25, 0.5, 1.0])) for f in range(3) for b in range(5) for y in range(4) if rng.random() < 0.7] + [(3, 0, 0.0, 2.0)]
    histogram = spark.createDataFrame(rows, "feature int, bin int, label double, w double").localCheckpoint()
    wanted = boosting.stump_choices(histogram).orderBy("impurity", "feature", "bin").first()
    spark.sparkContext.setJobGroup("stump", "stump")
    got = boosting.best_stump(histogram).first()
    spark.sparkContext.setJobGroup("", "")
    assert got.asDict() == wanted.asDict()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("stump")) <= 3
    assert boosting.best_stump(histogram.where("feature = 3")).first() is None


def test_votes_for_three_writers_are_derived_once(spark, monkeypatch):
    x, seen = counted(spark, F.col("id").cast("double"))
    rows = spark.range(40).select(F.lit("s").alias("sample"), F.col("id").cast("string").alias("seq"), x.cast("string").alias("taxID_a_0"), F.lit("1").alias("taxID_b_0"), F.lit("2").alias("taxID_c_0"), (F.col("id") % 4).alias("l_linenumber"))
    monkeypatch.setattr(files.I, "calls", lambda spark, d: rows)
    assert files.pooled_votes(spark, "").count() == 40 and seen.value == 40


def test_profiles_are_counted_once_for_all_steps(spark, monkeypatch):
    x, seen = counted(spark, F.col("id").cast("double"))
    rows = spark.range(30).select(F.col("id").cast("string").alias("header"), F.concat(F.repeat(F.lit("ACGGT"), (x % 7 + 2).cast("int")), F.repeat(F.lit("TGA"), (F.col("id") % 5).cast("int"))).alias("sequence"))
    monkeypatch.setattr(catalogue.I, "contigs", lambda spark, d: rows)
    assert catalogue.composition_clusters(spark, "").count() == 30 and seen.value == 30


def test_reports_leave_only_their_files(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "new_path", lambda spark: str(tmp_path / uuid.uuid4().hex))
    n = files.reports_from_files(spark, data).count()
    assert n == 5 * files.I.calls(spark, data).count()
    names = [p.name for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    assert all(re.fullmatch(r"[A-Z]_\d+\.\w+\.out(\.gz)?", name) for name in names)
    assert {name.split(".", 1)[1] for name in names} == {"kraken.out.gz", "krakenu.out.gz", "kaiju.out.gz", "mp4.out.gz", "custom_mytool.out"}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in LEAN_WRITES}
    blocks = lambda: {str(b) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if str(b).startswith("shuffle")}
    there = blocks()
    with settings(spark, LEAN_WRITES):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "out"))
    for _ in range(100):  # files are deleted in the background
        if blocks() <= there:
            break
        time.sleep(0.1)
    assert blocks() <= there and {k: spark.conf.get(k) for k in LEAN_WRITES} == before
