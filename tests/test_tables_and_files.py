from pyspark.sql import functions as F

from quorumkit.operators import sequences, taxonomy
from quorumkit.sinks import tables as K
from quorumkit.sources import sequences as seqio
from quorumkit.sources import tables as T


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_nodes_rank_and_name_tables(spark):
    nodes = T.parse_nodes(lines(spark, "562\t|\t561\t|\tspecies\t|", "561\t|\t543\t|\tgenus\t|", "x\t|\t1\t|\tbad\t|", "543\t|\t1\t|\tfamily\t|", "1\t|\t1\t|\tno rank\t|", "7\t|\t1\t|\tspecies\t|"))
    assert nodes.count() == 5
    assert [tuple(r) for r in taxonomy.ancestor_at_rank(nodes, "genus").orderBy("tax_id").collect()] == [(561, 561), (562, 561)]
    wanted = spark.createDataFrame([(562,)], "tax_id long")
    assert taxonomy.lineage(nodes, wanted).first()["lineage"] == {"species": 562, "genus": 561, "family": 543}
    ranks = T.parse_rank_table(lines(spark, "# c", "taxid|genera_taxid", "562|561", "9606\t9605", "4932,4930"))
    assert {r["taxid"]: r["mapped"] for r in ranks.collect()} == {"562": "561", "9606": "9605", "4932": "4930"}
    names = T.parse_name_table(lines(spark, "562|E. coli|x", "0|none"))
    assert [tuple(r) for r in names.collect()] == [("562", "E. coli|x")]
    assert [r[0] for r in K.map_lines(names, "taxid", "name").collect()] == ["562|E. coli/x"]
    votes = spark.createDataFrame([("a", "562.0"), ("b", "77"), ("c", None)], ["seq", "label"])
    assert {r["seq"]: r["label"] for r in taxonomy.roll_up(votes, ranks).collect()} == {"a": "561", "b": "77", "c": None}


def test_pooled_tables(spark, tmp_path):
    (tmp_path / "s1.annotation.csv").write_text("seq,taxID_kaiju_0,taxID_kaiju_1\nr1,0,5\nr2,,7\n")
    (tmp_path / "s2.annotation.csv").write_text("seq,taxID_kraken2_0\nr3,9\n")
    (tmp_path / "combined_annotation_table.csv").write_text("seq\nx\n")
    out = T.read_pooled(spark, [str(p) for p in tmp_path.iterdir()])
    assert {(r["seq"], r["taxID_kaiju"], r["taxID_kraken2"], r["sample"]) for r in out.collect()} == {("r1", "0", None, "s1"), ("r2", "7", None, "s1"), ("r3", None, "9", "s2")}


def test_fasta_and_fastq_round_trip(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one x\nACGT\nACG\n\n>two\nTTTT\n")
    got = seqio.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("contig_no")
    assert [(r["header"], r["sequence"]) for r in got.collect()] == [("one x", "ACGTACG"), ("two", "TTTT")]
    K.write_fasta(got, str(tmp_path / "out"))
    assert sorted(r["sequence"] for r in seqio.read_fasta(spark, str(tmp_path / "out")).collect()) == ["ACGTACG", "TTTT"]
    (tmp_path / "a.fastq").write_text("@r1/1 z\nACGT\n+\n@III\n@r2/1\nGG\n+\nII\n@cut\nAA\n")
    reads = seqio.read_fastq(spark, str(tmp_path / "a.fastq")).orderBy("ord")
    assert [(r["read_id"], r["seq"], r["qual"]) for r in reads.collect()] == [("r1", "ACGT", "@III"), ("r2", "GG", "II")]
    K.write_fastq(reads, str(tmp_path / "fq"))
    assert seqio.read_fastq(spark, str(tmp_path / "fq")).count() == 2
    assert seqio.pair_mates(reads, reads.where("ord = 0")).count() == 1


def test_gff_and_coding_sequences(spark):
    gff = T.parse_gff(lines(spark, "# x", "c1\ts\tCDS\t1\t12\t.\t+\t0\tID=cds1;protein_id=p1", 'c2.1\ts\tCDS\t1\t12\t.\t-\t0\tprotein_id "p2"; x "y"', "none\ts\tCDS\t1\t3\t.\t+\t0\tprotein_id=p3", "short\tline"))
    contigs = spark.createDataFrame([("c1", 0, "ATGGAATTCTAA"), ("xc2.1|y", 1, "TTAGAATTCCAT")], ["header", "contig_no", "sequence"])
    got = sequences.coding_sequences(gff, contigs, min_aa=1)
    assert {r["protein_id"]: r["aa"] for r in got.collect()} == {"p1": "MEF", "p2": "MEF"}
    assert sequences.coding_sequences(gff, contigs).count() == 0


def test_catalogues(spark):
    files = spark.createDataFrame([("/g/562.faa",), ("/g/562.fna",), ("/g/ecoli.fna",), ("/g/9606.fa.gz",), ("/g/9606.txt",)], ["path"])
    one = T.one_file_per_label(T.catalogue_genomes(files))
    assert {r["taxid"]: r["path"] for r in one.collect()} == {"562": "/g/562.fna", "9606": "/g/9606.fa.gz"}
    assert {r["taxid"]: r["path"] for r in T.genome_by_priority(T.catalogue_genomes(files)).collect()} == {"562": "/g/562.fna", "9606": "/g/9606.fa.gz"}
    fq = spark.createDataFrame([("/r/a_R1.fastq.gz",), ("/r/a_R2.fastq.gz",), ("/r/b_R1.fq",), ("/r/c_R2.fq",)], ["path"])
    assert {r["sample"]: (r["r1"], r["r2"]) for r in T.catalogue_fastq(fq).collect()} == {"a": ("/r/a_R1.fastq.gz", "/r/a_R2.fastq.gz"), "b": ("/r/b_R1.fq", None)}


def test_writers(spark, tmp_path):
    wide = spark.createDataFrame([("s1", "b", "5"), ("s1", "a", "6"), ("s2", "c", "7")], ["sample", "seq", "taxID_k_0"])
    K.write_votes(wide, str(tmp_path / "votes"))
    assert (tmp_path / "votes" / "s1.annotation.csv").read_text() == "seq,taxID_k_0\na,6\nb,5\n"
    ab = spark.createDataFrame([("k a", "s1", "5", 2), ("k a", "s2", "6", 3)], ["annotator", "sample", "taxid", "n"])
    K.write_abundance(ab, ["s1", "s2"], str(tmp_path / "ab"))
    assert {(r["taxid"], r["N_s1"], r["N_s2"]) for r in spark.read.csv(str(tmp_path / "ab"), header=True).collect()} == {("5", "2", "0"), ("6", "0", "3")}
    assert [p.name for p in (tmp_path / "ab").iterdir() if not p.name.startswith(".")] == ["k_a.csv"]
    plan = spark.createDataFrame([("562", 3), ("9606", 0)], ["source", "n"])
    assert K.write_read_counts(plan, str(tmp_path / "plan")) == 3
    assert spark.read.csv(str(tmp_path / "plan"), sep="\t").count() == 1
    assert T.read_features(spark, str(tmp_path / "absent.tsv")) is None
    K.write_features(plan, str(tmp_path / "f.tsv"))
    assert T.read_features(spark, str(tmp_path / "f.tsv")).count() == 2
    assert spark.range(1).select(K.safe_file_name(F.lit("a b/c"))).first()[0] == "a_b_c"


def test_run_folder_is_removed(spark):
    from pathlib import Path

    from quorumkit.sinks.shared import materialize, remove_run_folder, run_folder

    assert materialize(spark.range(3)).count() == 3
    here = Path(run_folder(spark).removeprefix("file:"))
    assert any(here.iterdir())
    remove_run_folder(spark)
    assert not here.exists()
