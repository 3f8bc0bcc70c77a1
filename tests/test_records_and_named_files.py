"""Byte-range readers at the edges of ranges, and writers whose files have names of their own."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from quorumkit.sinks import named
from quorumkit.sinks import tables as K
from quorumkit.sources import records
from quorumkit.sources import sequences as seqio
from quorumkit.sources import tables as T


def fastq_text(n, seed, end="\n"):
    rng, out = random.Random(seed), []
    for i in range(n):
        size = rng.randint(0, 9)
        qual = "".join(rng.choice("@+I!") for _ in range(size))
        out.append(f"@r{i}/1 x{end}{''.join(rng.choice('ACGT') for _ in range(size))}{end}+{'r' * rng.randint(0, 1)}{end}{qual}{end}")
    return "".join(out)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_range_size_gives_every_record_once(tmp_path, end):
    """Quality lines of '@' and '+' at all offsets from the edges of ranges, empty reads, a truncated end."""
    text = fastq_text(40, 3, end)
    path = tmp_path / "a.fastq"
    path.write_bytes((text + "@cut" + end + "AC" + end).encode())
    lines = text.split(end)
    want = [(lines[i][1:], lines[i + 1], lines[i + 3]) for i in range(0, 160, 4)]
    for size in (1, 2, 3, 7, 16, 33, 64, 500, 100_000):
        reader = records.FastqReader({"path": str(path), "rangebytes": str(size)})
        got = [tuple(f.decode() for f in r) for part in reader.partitions() for r in reader.records(part)]
        assert got == want, size


def test_fasta_ranges(tmp_path):
    text = "junk\n>one x\nACGT\n\nAC GT\n>two\n>three\n" + "A" * 50 + "\n" + "C" * 50
    path = tmp_path / "a.fa"
    path.write_text(text)
    want = [("one x", "ACGTACGT"), ("two", ""), ("three", "A" * 50 + "C" * 50)]
    for size in range(1, len(text) + 2):
        reader = records.FastaReader({"path": str(path), "rangebytes": str(size)})
        assert [tuple(f.decode() for f in r) for part in reader.partitions() for r in reader.records(part)] == want, size


def test_places_of_many_ranges_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fastq").write_text(fastq_text(300, 1))
    (tmp_path / "in" / "b.fastq.gz").write_bytes(gzip.compress(fastq_text(50, 2).encode()))
    (tmp_path / "in" / "_hidden.fastq").write_text("x")
    (tmp_path / "in" / "empty.fastq").write_text("")
    raw = seqio.fastq_records(spark, str(tmp_path / "in"), range_bytes=700)
    assert "Exchange" not in raw._jdf.queryExecution().executedPlan().toString()
    assert raw.rdd.getNumPartitions() > 8
    for paths in (str(tmp_path / "in"), [str(tmp_path / "in" / "a.fastq"), "file:" + str(tmp_path / "in" / "b.fastq.gz")], str(tmp_path / "in" / "*.fastq*")):
        rows = seqio.read_fastq(spark, paths, range_bytes=700).orderBy("file", "ord").collect()
        assert [(r.file[-8:], r.ord, r.read_id) for r in rows] == [("/a.fastq", i, f"r{i}") for i in range(300)] + [("fastq.gz", i, f"r{i}") for i in range(50)]
    with pytest.raises(Exception, match="none"):
        seqio.read_fastq(spark, str(tmp_path / "none")).count()


def test_large_groups_go_on_in_numbered_files(spark, tmp_path):
    rows = spark.range(250).select(F.when(F.col("id") < 225, "hot one").when(F.col("id") < 249, "b").alias("sample"), F.col("id").cast("string").alias("seq"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    named.write_named(rows, F.col("sample"), ".annotation.csv", ["seq"], str(tmp_path / "out"), drop=["sample"], file_rows=100)
    files = {p.name: p.read_text().splitlines() for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert {k: len(v) - 1 for k, v in files.items()} == {"hot_one.annotation.csv": 100, "hot_one.2.annotation.csv": 100, "hot_one.3.annotation.csv": 25, "b.annotation.csv": 24, "null.annotation.csv": 1}
    hot = sum((files[f"hot_one{i}.annotation.csv"][1:] for i in ("", ".2", ".3")), [])
    assert [h.split(",")[0] for h in hot] == sorted(str(i) for i in range(225))
    assert files["null.annotation.csv"] == ["seq,x", "249,"]
    pooled = T.read_pooled(spark, str(tmp_path / "out"))
    assert {(r["sample"], r["count"]) for r in pooled.groupBy("sample").count().collect()} == {("hot_one", 225), ("b", 24), ("null", 1)}


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    out = tmp_path / "out"
    K.write_reprofiled(spark.createDataFrame([("s1", "a"), ("s2", "b")], "sample string, seq string"), str(out))
    before = {p.name for p in out.iterdir()}
    assert {"s1_reprofiled.csv", "s2_reprofiled.csv"} <= before
    spark.dataSource.register(named.NamedCsv)
    broken = spark.range(0, 40, 1, 4).select(F.concat(F.lit("n"), F.spark_partition_id().cast("string")).alias("__file"), F.when(F.col("id") == 39, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="stop"):
        broken.write.format("quorum_named_csv").mode("overwrite").save(str(out))
    assert {p.name for p in out.iterdir()} == before
    K.write_reprofiled(spark.createDataFrame([("s3", "a")], "sample string, seq string"), str(out))
    assert {p.name for p in out.iterdir() if not p.name.startswith(".")} == {"s3_reprofiled.csv"}
    K.write_reprofiled(spark.createDataFrame([], "sample string, seq string"), str(out))
    assert T.read_pooled(spark, []) is None


def test_pooled_tables_with_repeated_headers(spark, tmp_path):
    (tmp_path / "s1.annotation.csv").write_text('seq,taxID_k,taxID_k,"a,b"\nr1,,5,x\nr2,1,2,\n')
    (tmp_path / "s2.annotation.csv").write_text("seq,taxID_k\nr3,9\n")
    got = {(r["seq"], r["taxID_k"], r["a,b"], r["sample"]) for r in T.read_pooled(spark, str(tmp_path)).collect()}
    assert got == {("r1", "5", "x", "s1"), ("r2", "1", None, "s1"), ("r3", "9", None, "s2")}


def test_files_are_listed(spark, tmp_path):
    for name in ("562.fna", "x.fna", "9.txt", "deep/7_R1.fq", "deep/7_R2.fq"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert sorted(r.path.rsplit("/", 1)[1] for r in T.list_files(spark, str(tmp_path)).collect()) == ["562.fna", "7_R1.fq", "7_R2.fq", "9.txt", "x.fna"]
    assert [r.taxid for r in T.catalogue_genomes(T.list_files(spark, str(tmp_path), "*.fna")).collect()] == ["562"]


@pytest.mark.parametrize("at_places", [True, False])
def test_a_large_name_is_one_file_in_order(spark, tmp_path, monkeypatch, at_places):
    """Pieces of several tasks, copied to their places or, where a file system has none, as a stream."""
    if not at_places:
        monkeypatch.setattr(named.arrow_fs, "LocalFileSystem", type("Other", (), {}))
        monkeypatch.setattr(named, "file_system", lambda path: (records.arrow_fs.FileSystem.from_uri("file://" + path)[0], path))
    rows = spark.range(0, 6_000, 1, 5).select(F.when(F.col("id") % 10 < 8, "hot").otherwise("b").alias("sample"), F.lpad(F.col("id").cast("string"), 6, "0").alias("seq"), F.when(F.col("id") % 2 == 0, 'a,"b"').alias("x"))
    named.write_named(rows.unionByName(rows.where("seq = '000000'").withColumn("x", F.lit("Z"))), F.col("sample"), ".csv", ["seq"], str(tmp_path / "out"), drop=["sample"])
    files = {p.name: p.read_text().splitlines() for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert set(files) == {"hot.csv", "b.csv"}
    line = lambda i: f"{i:06d}," + ('"a,""b"""' if i % 2 == 0 else "")
    assert files["hot.csv"] == ["seq,x", "000000,Z", line(0), *(line(i) for i in range(1, 6_000) if i % 10 < 8)]
    assert files["b.csv"] == ["seq,x", *(line(i) for i in range(6_000) if i % 10 >= 8)]
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def test_many_small_ranges_are_read_by_a_bounded_number_of_tasks(tmp_path, monkeypatch):
    path = tmp_path / "a.fastq"
    path.write_text(fastq_text(300, 5))
    monkeypatch.setattr(records, "MOST_TASKS", 7)
    reader = records.FastqReader({"path": str(path), "rangebytes": "50"})
    parts = reader.partitions()
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(parts) <= 7 and [r["header"] for r in rows] == [f"r{i}/1 x" for i in range(300)]
    assert {r["block"] % 50 for r in rows} == {0} and len({(r["block"], r["at"]) for r in rows}) == 300


def test_many_small_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    listed = []
    monkeypatch.setattr(named, "materialize", lambda df, real=named.materialize: listed.append(real(df)) or listed[-1])
    named.write_named(spark.range(60).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("line")), F.col("k"), ".txt", ["line"], str(tmp_path / "out"), drop=["k"])
    assert len(list((tmp_path / "out").glob("*.txt"))) == 60
    assert listed[0].select("part").distinct().count() >= 3
