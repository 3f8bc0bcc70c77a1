import gzip

import pytest
from pyspark.sql import functions as F

from quorumkit.functions import labels as L
from quorumkit.operators import combine
from quorumkit.sources import reports


def col(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_truth_from_read_ids(spark):
    ids = ["r1|taxid:562", "R|TaxID:9606_x", "ecoli.fna_3", "x|scer.fna|1", "plain", None]
    assert col(spark, ids, L.true_label) == ["562", "9606", "562", "4932", "", ""]
    assert col(spark, ["a-77-b", "taxid:5"], lambda c: L.true_label(c, r"a-(\d+)-b")) == ["77", "5"]


def test_canonical_and_display(spark):
    values = [None, " ", "NaN", "562.0", "tax 9606 x", "other", "-3.0", "1.25"]
    assert col(spark, values, L.canonical_label) == ["0", "0", "0", "562", "9606", "other", "3", "1"]
    assert col(spark, values, L.display_token) == ["0", "0", "0", "562", "tax 9606 x", "other", "-3", "1.25"]
    assert col(spark, ["", "NA", "na", None, "7"], L.combiner_label) == ["0", "0", "na", "0", "7"]
    long = "a" * 30
    assert col(spark, [long], lambda c: L.display_label(F.lit("5"), c)) == ["a" * 24 + "…"]


def test_column_selectors():
    cols = ["seq", "taxID_kaiju_0", "taxid_OTHER_confidence", "N_x", "length", "true", "taxID_kraken2...2"]
    assert L.label_columns(cols) == ["taxID_kaiju_0", "true", "taxID_kraken2...2"]
    assert L.annotator_columns(cols) == ["taxID_kaiju_0", "N_x", "taxID_kraken2...2"]
    assert [L.tool_name(c) for c in cols] == [None, "kaiju", None, None, None, None, "kraken2"]
    assert L.normalize_rank("Genera") == "genus" and L.normalize_rank("off") is None and L.rank_column("g") == "genera_taxid"
    assert L.annotator_name("taxID_kaiju_3") == "kaiju"


def test_coalesce_keeps_zero_and_standardize_skips_bad_text(spark):
    df = spark.createDataFrame([("0", "9", "x", "5"), (None, "9", "3", "5")], ["taxID_a_0", "taxID_a_1", "taxid_k_0", "taxid_k_1"])
    assert [r["taxID_a"] for r in L.coalesce_same_names(df.select("taxID_a_0", "taxID_a_1")).collect()] == ["0", "9"]
    assert [r["taxid_k"] for r in L.standardize_by_tool(df.select("taxid_k_0", "taxid_k_1")).collect()] == [5.0, 3.0]


def test_model_input_drops_rows_without_numeric_truth(spark):
    df = spark.createDataFrame([("r", "s", "tax 5", "12", "7"), ("q", "s", None, "", "")], ["seq", "sample", "taxID_a", "length", "true"])
    assert [tuple(r) for r in L.model_input(df).collect()] == [(5.0, 12, 7.0)]


def write(path, text):
    path.write_text(text)


def test_combine_from_files(spark, tmp_path):
    write(tmp_path / "s1_x.kaiju.out", "C\treadB|taxid:562\t562\nC\treadA|taxid:9606\t9606\nC\treadA|taxid:9606\t999\nU\t\t5\n\nC\tshort\n")
    write(tmp_path / "s1_x.kraken2.out", "C\treadC|taxid:4932\tyeast (taxid 4932)\t150|150\tk\r\nC\treadA|taxid:9606\tman (TAXID 9606)\t126|126\tk\nU\treadD\tunclassified\t10\tk\n")
    write(tmp_path / "notes.txt", "nothing")
    report = reports.read_reports(spark, str(tmp_path))
    wide = combine.combine_reports(report, [("kaiju", 0), ("kraken2", 0)])
    got = {r["seq"]: (r["sample"], r["taxID_kaiju_0"], r["taxID_kraken2_0"], r["length"], r["true"]) for r in wide.collect()}
    assert got == {
        "readA|taxid:9606": ("s1", "9606", "9606", "126", "9606"),
        "readB|taxid:562": ("s1", "562", "0", "", "562"),
        "readC|taxid:4932": ("s1", "0", "4932", "150", "4932"),
        "readD": ("s1", "0", "0", "10", ""),
    }


def test_missing_reports_and_tool_names(spark, tmp_path):
    assert reports.read_reports(spark, str(tmp_path / "none")).count() == 0
    names = ["a.mp4.out", "a.custom_mpa.out", "b.unheard.out", "c.txt", "x.krakenu.out"]
    assert col(spark, names, reports.tool_of_file) == ["metaphlan", "mpa", "unheard", None, "krakenuniq"]
    assert col(spark, ["a_b_c.kaiju.out", "a.kaiju.out"], lambda c: reports.sample_of_file(c, 2)) == ["a_b", "a"]


def test_gzipped_reports_are_read_beside_plain_ones(spark, tmp_path):
    write(tmp_path / "s1_a.kaiju.out", "C\tr1\t5\r\nC\tshort\n\n")
    with gzip.open(tmp_path / "s1_b.kaiju.out.gz", "wt") as f:
        f.write("C\tr2\t6\nU\t\t7\n")
    with gzip.open(tmp_path / "s2_a.custom_mytool.out.gz", "wt") as f:
        f.write("r3\t8\t90\n")
    write(tmp_path / "s2_a.out", "r4\t8\n")
    got = reports.read_reports(spark, str(tmp_path)).select("sample", "tool", "run_idx", "seq", "taxid", "length").collect()
    assert sorted(map(tuple, got)) == [("s1", "kaiju", 0, "r1", "5", None), ("s1", "kaiju", 1, "r2", "6", None), ("s2", "mytool", 0, "r3", "8", "90")]
    assert col(spark, ["a.b.out.gz", "a.out.gz", "a.b.out.zip", "a.out"], reports.tool_of_file) == ["b", None, None, None]


def test_lines_of_reports_stay_where_they_are_read(spark, tmp_path):
    write(tmp_path / "s1_a.kaiju.out", "C\tr1\t5\n")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the reports were large
    try:
        report = reports.read_reports(spark, str(tmp_path))
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert report.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    above = plan[: plan.index("FileScan text")].splitlines()
    assert not any("Exchange" in line for line in above)


def test_sam_centrifuge_markers_and_contigs(spark):
    sam = spark.createDataFrame([("@SQ\tx",), ("r1\t0\tc1\t5",), ("r2\t0\t*\t0",), ("r3\t0\tc2\t1",)], ["value"])
    contigs = spark.createDataFrame([("c1", "562"), ("c2", "0")], ["contig", "taxid"])
    assert [tuple(r) for r in reports.map_contig_labels(reports.read_sam(sam), contigs).collect()] == [("r1", "562")]
    cf = spark.createDataFrame([("readID\tseqID\ttaxID",), ("a\ts\t7",), ("b\ts\t0",)], ["value"])
    assert [tuple(r) for r in reports.read_centrifuge(cf).collect()] == [("a", "7")]
    lines = spark.createDataFrame([("s", "metaphlan", 0, 0, "r\tx|M12-c3|y"), ("s", "kaiju", 0, 1, "C\tq\t9")], ["sample", "tool", "run_idx", "line_no", "value"])
    markers = spark.createDataFrame([("M12-c3", "88")], ["ref_id", "tax_id"])
    assert {r["seq"]: r["taxid"] for r in reports.map_markers(reports.parse_reports(lines), markers).collect()} == {"r": "88", "q": "9"}


def test_features_join_only_with_keys(spark):
    votes = spark.createDataFrame([("r1", "5")], ["seq", "taxID_a"])
    feats = spark.createDataFrame([("r1", 0.5)], ["read_id", "gc"])
    assert combine.join_features(votes, feats).first()["gc"] == pytest.approx(0.5)
    assert combine.join_features(votes, None) is votes
    assert combine.join_features(votes, feats.select("gc")).columns == votes.columns
