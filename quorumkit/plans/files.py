"""Registered queries over files: what the writers wrote to the shared folder is read back by the readers.

Every query starts from the given tables and says in SQL what must come back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumkit.functions import labels as L
from quorumkit.operators import abundance as A
from quorumkit.operators import allocate, metrics, registry, reprofile, sequences
from quorumkit.plans import inputs as I
from quorumkit.operators.ranking import running_sum
from quorumkit.plans.catalogue import _CALLS, _CODONS, _CONTIGS, _GENOMES, _LETTERS, _NODES, _VOTES, _abundance, _genomes, query
from quorumkit.sinks import tables as K
from quorumkit.sinks.named import write_named
from quorumkit.sinks.shared import LEAN_WRITES, delete_path, materialize, new_path, settings
from quorumkit.sources import reports, sequences as seqio, tables as T


def rename_files(spark: SparkSession, folder: str, name: Callable[[str, int], str]) -> str:
    """Move the data files below a written folder to names of their own in a new folder, which is returned.

    ``name`` gets the value of the partition folder that a file is in and its number.
    """
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(new_path(spark))
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    files, found = fs.listFiles(source, True), []
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            found.append((path.getParent().getName().rpartition("=")[2], path.getName(), path))
    for i, (value, _, path) in enumerate(sorted(found, key=lambda x: x[:2])):
        fs.rename(path, jvm.org.apache.hadoop.fs.Path(target, name(value, i)))
    return target.toString()


def text_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Lines (value) after a round through text files."""
    path = new_path(spark)
    lines.select("value").write.text(path)
    return spark.read.text(path)


def joined(*columns: str | Column, by: str = "\t") -> Column:
    return F.concat_ws(by, *(F.col(c) if isinstance(c, str) else c for c in columns)).alias("value")


# reports --------------------------------------------------------------------


@query(
    f"""WITH {_CALLS}
    SELECT sample, 'kraken1' AS tool, seq, "taxID_a_0" AS taxid, length FROM calls
    UNION ALL SELECT sample, 'krakenuniq', seq, "taxID_b_0", length FROM calls
    UNION ALL SELECT sample, 'kaiju', seq, "taxID_c_0", NULL FROM calls
    UNION ALL SELECT sample, 'metaphlan', seq, CASE WHEN l_linenumber % 2 = 0 THEN 'M' || l_suppkey || '-c' || l_linenumber ELSE "taxID_a_0" END, NULL FROM calls
    UNION ALL SELECT sample, 'mytool', seq, "taxID_b_0", CASE WHEN l_linenumber % 3 = 0 THEN length END FROM calls"""
)
def reports_from_files(spark, d):
    """Reports of five tools as files <sample>_<n>.<tool>.out, gzipped but for one tool, and a folder that does not exist."""
    marker = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("x|M"), F.col("l_suppkey").cast("string"), F.lit("-c"), F.col("l_linenumber").cast("string"), F.lit("|y"))).otherwise(F.col("taxID_a_0"))
    lines = {
        "kraken": joined(F.lit("C"), "seq", "taxID_a_0", F.concat("length", F.lit("|9")), F.lit("k:1")),
        "krakenu": joined(F.lit("C"), "seq", "taxID_b_0", "length", F.lit("k:1")),
        "kaiju": F.concat(joined(F.lit("C"), "seq", "taxID_c_0"), F.lit("\r")),
        "mp4": joined("seq", marker),
        "custom_mytool": joined("seq", "taxID_b_0", F.when(F.col("l_linenumber") % 3 == 0, F.col("length"))),
    }
    derived, folders = new_path(spark), []
    with settings(spark, LEAN_WRITES):
        calls = materialize(I.calls(spark, d).select("sample", "seq", *I.ANNOTATORS, "length", "l_linenumber", "l_suppkey"), f"{derived}/calls", compression="zstd")  # every tool's report starts from it
        broken = materialize(calls.select("sample", F.lit("C").alias("value")).distinct(), f"{derived}/broken")  # too few fields
        for tool, value in lines.items():
            path, (end, codec) = new_path(spark), ("", "none") if tool == "custom_mytool" else (".gz", "gzip")
            calls.select("sample", value.alias("value")).unionByName(broken).write.partitionBy("sample").option("zlib.compress.level", "BEST_SPEED").text(path, compression=codec)
            folders.append(rename_files(spark, path, lambda sample, i, tool=tool, end=end: f"{sample}_{i}.{tool}.out{end}"))
    delete_path(spark, derived)
    none = reports.read_reports(spark, f"{folders[0]}/none/*.out")
    return reports.read_reports(spark, folders).unionByName(none).select("sample", "tool", "seq", "taxid", "length")


@query(f"""WITH {_CALLS} SELECT seq, CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN cast(l_suppkey AS varchar) END AS taxid FROM calls""")
def marker_labels(spark, d):
    """Marker ids through a marker map file."""
    calls = I.calls(spark, d)
    name = F.concat(F.lit("M"), F.col("s_suppkey").cast("string"), F.lit("-c1"))
    lines = text_lines(spark, I.table(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(joined(name, F.col("s_suppkey").cast("string"))))
    marker = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("M"), F.col("l_suppkey").cast("string"), F.lit("-c1"))).otherwise(F.lit("no marker"))
    rows = calls.select("sample", F.lit("metaphlan").alias("tool"), F.lit(0).alias("run_idx"), F.lit(0).alias("line_no"), joined("seq", marker))
    return reports.map_markers(reports.parse_reports(rows), reports.parse_marker_map(lines)).select("seq", "taxid")


@query(f"""WITH {_CALLS}, {_GENOMES} SELECT seq, "taxID_a_0" AS taxid FROM calls WHERE l_linenumber % 4 <> 0 AND "taxID_a_0" IN (SELECT taxid FROM genomes)""")
def alignments_to_labels(spark, d):
    calls = I.calls(spark, d)
    contig = F.when(F.col("l_linenumber") % 4 == 0, "*").otherwise(F.concat(F.lit("ctg"), F.col("taxID_a_0")))
    header = calls.select(F.concat(F.lit("@SQ\tSN:"), contig).alias("value")).distinct()
    lines = text_lines(spark, calls.select(joined("seq", F.lit("0"), contig, F.lit("1"))).unionByName(header))
    known = _genomes(spark, d).select(F.concat(F.lit("ctg"), F.col("taxid")).alias("contig"), "taxid").unionByName(spark.range(1).select(F.lit("ctg0").alias("contig"), F.lit("0").alias("taxid")))
    return reports.map_contig_labels(reports.read_sam(lines), known)


@query(f"""WITH {_CALLS} SELECT seq, "taxID_c_0" AS taxid FROM calls WHERE "taxID_c_0" <> '0'""")
def centrifuge_rows(spark, d):
    calls = I.calls(spark, d)
    head = spark.range(1).select(joined(F.lit("readID"), F.lit("seqID"), F.lit("taxID")))
    return reports.read_centrifuge(text_lines(spark, calls.select(joined("seq", F.lit("s1"), "taxID_c_0", F.lit("9"))).unionByName(head)))


@query(f"""WITH {_CALLS} SELECT DISTINCT l_orderkey::varchar AS seq, '9606' AS taxid FROM calls""")
def constant_annotator(spark, d):
    """The plug-in annotator that gives every read id one label, both mates together."""
    reads = I.calls(spark, d).select(F.col("l_orderkey").cast("string").alias("read_id"), F.lit("ACGT").alias("seq"))
    return registry.annotate(reads, ["constant9606"]).select("seq", "taxid")


@query(f"""WITH {_CALLS} SELECT seq, "true" AS own, '' AS missing FROM calls""")
def truth_by_pattern(spark, d):
    """Truth from a caller's pattern, and from ids that carry none."""
    rows = I.calls(spark, d).select("seq", F.concat(F.lit("r"), F.col("seq"), F.lit("@t"), F.col("true")).alias("id"))
    return rows.select("seq", L.true_label(F.col("id"), r"@t(\d+)").alias("own"), L.true_label(F.col("seq")).alias("missing"))


# votes ----------------------------------------------------------------------


@query(
    f"""WITH {_CALLS} SELECT sample, seq, "taxID_a_0" AS "taxID_a", CASE WHEN l_linenumber % 2 = 0 THEN "taxID_b_0" END AS "taxID_b", CASE WHEN l_linenumber % 2 = 1 THEN "taxID_c_0" END AS "taxID_c" FROM calls"""
)
def pooled_votes(spark, d):
    """Per-sample vote files of two headers, read as one table; a pooled file among them is skipped."""
    calls = materialize(I.calls(spark, d).select("sample", "seq", *I.ANNOTATORS, "l_linenumber"))  # three writers start from it
    folders = [new_path(spark) for _ in range(3)]
    for folder, column, rest in zip(folders, "bc", (0, 1)):
        K.write_votes(calls.where(F.col("l_linenumber") % 2 == rest).select("sample", "seq", "taxID_a_0", f"taxID_{column}_0"), folder)
    K.write_pooled(calls.select("sample", "seq", "taxID_a_0"), folders[2])
    return T.read_pooled(spark, folders).select("sample", "seq", "taxID_a", "taxID_b", "taxID_c")


@query(f"""WITH {_CALLS} SELECT sample || '.annotation.csv' AS file, row_number() OVER (PARTITION BY sample ORDER BY seq) AS place, seq, "taxID_a_0" AS label, nullif(length, '7') AS length FROM calls""")
def vote_files(spark, d):
    """Vote files by their names, and the order of the reads in each."""
    path = new_path(spark)
    K.write_votes(I.calls(spark, d).select("sample", "seq", "taxID_a_0", F.nullif("length", F.lit("7")).alias("length")), path)
    lines = spark.read.csv(path, header=True).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "seq", F.col("taxID_a_0").alias("label"), "length")
    return running_sum(lines, ["file"], ["block", "at"], name="before").select("file", (F.col("before") + 1).alias("place"), "seq", "label", "length")


@query(f"""WITH {_CALLS} SELECT 'combined_annotation_table.csv' AS file, sample, seq, CASE WHEN l_linenumber % 2 = 0 THEN 'a, "b"' ELSE "taxID_a_0" END AS label FROM calls""")
def pooled_file(spark, d):
    """The pooled table as one named file, with values that need quotes."""
    path = new_path(spark)
    label = F.when(F.col("l_linenumber") % 2 == 0, 'a, "b"').otherwise(F.col("taxID_a_0"))
    K.write_pooled(I.calls(spark, d).select("sample", "seq", label.alias("label")), path)
    return spark.read.csv(path, header=True, escape='"').select(F.col("_metadata.file_name").alias("file"), "sample", "seq", "label")


@query(f"""WITH {_CALLS} SELECT seq, "taxID_a_0" AS corrected, sample || '_reprofiled.csv' AS file FROM calls""")
def reprofiled_files(spark, d):
    path = new_path(spark)
    K.write_reprofiled(I.calls(spark, d).select("sample", "seq", F.col("taxID_a_0").alias("corrected")), path)
    return spark.read.csv(path, header=True).select("seq", "corrected", F.col("_metadata.file_name").alias("file"))


@query(f"""WITH {_CALLS} SELECT seq, "taxID_a_0" AS taxid FROM calls""")
def report_files(spark, d):
    path = new_path(spark)
    K.write_report(I.calls(spark, d).select("seq", F.col("taxID_a_0").alias("taxid")), path)
    return spark.read.csv(path, sep="\t", schema="seq string, taxid string")


@query(f"""WITH {_CALLS} SELECT seq, CASE WHEN l_linenumber % 3 = 0 THEN "taxID_b_0"::double ELSE "taxID_a_0"::double END AS taxid_kraken, "taxID_c_0"::double AS taxid_kaiju FROM calls""")
def votes_by_tool(spark, d):
    """Columns of one tool merge after they became numbers; bad text is skipped."""
    first = F.when(F.col("l_linenumber") % 3 == 0, "bad").otherwise(F.col("taxID_a_0"))
    wide = I.calls(spark, d).select("seq", first.alias("taxID_kraken_0"), F.col("taxID_b_0").alias("taxID_kraken_1"), F.col("taxID_c_0").alias("taxID.kaiju.0"), F.lit("0.5").alias("taxID_kaiju_confidence"))
    return L.standardize_by_tool(wide).select("seq", "taxid_kraken", "taxid_kaiju")


@query(f"""WITH {_CALLS} SELECT seq, CASE WHEN l_linenumber % 3 = 0 THEN "taxID_b_0" ELSE "taxID_a_0" END AS "taxID_kraken", length AS len FROM calls""")
def merged_columns(spark, d):
    first = F.when(F.col("l_linenumber") % 3 != 0, F.col("taxID_a_0"))
    wide = I.calls(spark, d).select("seq", first.alias("taxid_kraken_0"), F.col("taxID_b_0").alias("taxID_kraken_1"), F.col("length").alias("len...3"))
    return L.coalesce_same_names(wide)


@query(f"""WITH {_CALLS} SELECT seq, "taxID_a_0", length, CASE WHEN s_name IS NULL THEN '' ELSE s_name END AS "true" FROM calls LEFT JOIN (SELECT cast(n_nationkey + 100 AS varchar) AS k, n_name AS s_name FROM nation WHERE n_nationkey % 4 <> 0) ON k = "true" """)
def exported_votes(spark, d):
    """The export projection, with the truth renamed through a table."""
    names = I.table(spark, d, "nation").where("n_nationkey % 4 <> 0").select((F.col("n_nationkey") + 100).cast("string").alias("label"), F.col("n_name").alias("name"))
    wide = I.calls(spark, d).select("seq", "taxID_a_0", F.lit("0.5").alias("taxID_confidence"), F.col("length").alias("len_read"), "true", "l_discount")
    return L.export_columns(L.rename_truth(wide, names))


@query(f"""WITH {_CALLS} SELECT annotator, label, count(*) AS n FROM (SELECT 'a' AS annotator, "taxID_a_0" AS label FROM calls UNION ALL SELECT 'b', "taxID_b_0" FROM calls) GROUP BY ALL""")
def regeneration_votes(spark, d):
    """Votes of the columns that regeneration uses, under their annotators' names."""
    wide = I.calls(spark, d).select("seq", "taxID_a_0", "taxID_b_0", F.col("true").alias("taxID_true"), F.lit("1").alias("taxID_a_conf"))
    used = [c for c in L.regeneration_columns(wide.columns) if c in L.annotator_columns(wide.columns)]
    named = wide.select(*(F.col(c).alias(L.annotator_name(c)) for c in used))
    return named.unpivot([], named.columns, "annotator", "label").groupBy("annotator", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_CALLS} SELECT seq, CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE "taxID_a_0" END AS "taxID_a_0", CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE "true" END AS "true" FROM calls""")
def filled_votes(spark, d):
    rows = I.calls(spark, d).select("seq", F.when(F.col("l_linenumber") % 2 != 0, F.col("taxID_a_0")).alias("taxID_a_0"), F.when(F.col("l_linenumber") % 3 != 0, F.col("true")).alias("true"))
    return L.fill_votes(rows)


@query(f"""WITH {_CALLS} SELECT "taxID_a_0" AS label, count(*) AS n FROM calls WHERE "taxID_a_0" <> '0' GROUP BY ALL""")
def usable_labels(spark, d):
    """Labels written as decimals, cut to whole numbers, without those that are skipped."""
    label = L.integer_part(F.concat("taxID_a_0", F.lit(".0")))
    return I.calls(spark, d).select(label.alias("label")).where(~L.is_skipped(F.col("label"))).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_CALLS}, {_GENOMES} SELECT "true", "taxID_a_0" AS pred, count(*) AS freq FROM calls WHERE "true" IN (SELECT taxid FROM genomes) AND "taxID_a_0" IN (SELECT taxid FROM genomes) GROUP BY ALL""")
def allowed_pairs(spark, d):
    pairs = I.calls(spark, d).groupBy("true", F.col("taxID_a_0").alias("pred")).agg(F.count(F.lit(1)).alias("freq"))
    return metrics.keep_labels(pairs, _genomes(spark, d).select(F.col("taxid").alias("label")), "true", "pred")


@query(f"""WITH {_CALLS} SELECT "true", count(*) AS n, floor(count(*) * 0.2 + 0.5)::bigint AS n_test FROM calls GROUP BY ALL""")
def split_sizes(spark, d):
    """Test rows of each label in the stratified split."""
    return reprofile.stratified_split(I.calls(spark, d).select("seq", "true")).groupBy("true").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("long")).alias("n_test"))


# abundance ------------------------------------------------------------------

_AB = _VOTES + """, ab AS (SELECT annotator, sample, label AS taxid, count(*) AS n FROM votes GROUP BY ALL)"""


@query(f"WITH {_AB} SELECT annotator, taxid, sample, n FROM ab")
def abundance_files(spark, d):
    """Label-by-sample files of each annotator, read back into the long form."""
    path = new_path(spark)
    samples = [r["sample"] for r in I.calls(spark, d).select("sample").distinct().orderBy("sample").collect()]  # the columns of the files
    K.write_abundance(_abundance(spark, d), samples, path)
    annotator = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    wide = spark.read.csv(path, header=True).select(annotator.alias("annotator"), "taxid", *(F.col(f"N_{s}").cast("long").alias(s) for s in samples))
    return wide.unpivot(["annotator", "taxid"], samples, "sample", "n").where("n > 0")


@query(f"WITH {_AB} SELECT annotator, sample, CASE WHEN taxid::int % 2 = 0 THEN 'even' ELSE 'odd' END AS taxid, sum(n)::bigint AS n FROM ab GROUP BY ALL")
def abundance_summed(spark, d):
    return A.sum_labels(_abundance(spark, d).withColumn("taxid", F.when(F.col("taxid").cast("int") % 2 == 0, "even").otherwise("odd")))


@query(f"WITH {_VOTES} SELECT annotator, sample, label AS taxid, count(*) AS n FROM votes WHERE label <> '0' GROUP BY ALL")
def abundance_without_nulls(spark, d):
    return A.count_votes(I.votes(spark, d).withColumn("label", F.nullif("label", F.lit("0"))), keep_null=False)


@query(f"WITH {_CALLS} SELECT count(DISTINCT sample)::int AS observed, 7 AS asked FROM calls")
def sample_numbers(spark, d):
    calls = I.calls(spark, d)
    return spark.range(1).select(F.lit(A.observed_samples(calls)).cast("int").alias("observed"), F.lit(A.observed_samples(calls, 7)).cast("int").alias("asked"))


_PLAN = _AB + """, avail AS (SELECT * FROM ab JOIN genomes USING (taxid)), tot AS (SELECT annotator, sample, sum(n) AS t FROM avail GROUP BY ALL)"""


@query(f"WITH {_GENOMES}, {_PLAN} SELECT taxid AS source, sum(floor(n::double / t * 10000))::bigint AS n FROM avail JOIN tot USING (annotator, sample) GROUP BY taxid HAVING sum(floor(n::double / t * 10000)) > 0")
def read_count_files(spark, d):
    path = new_path(spark)
    plan = allocate.plan_totals(allocate.read_plan(_abundance(spark, d), _genomes(spark, d), 10_000)).groupBy("source").agg(F.sum("n").alias("n"))
    K.write_read_counts(plan, path)
    return spark.read.csv(path, sep="\t", schema="source string, n long")


@query("""WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT CASE WHEN rn <= round_even(n * 1.0 / 6, 0) THEN 's1' WHEN rn <= round_even(n * 1.0 / 6, 0) + round_even(n * 2.0 / 6, 0) THEN 's2' ELSE 's3' END AS sample, count(*) AS n, sum(o_orderkey)::bigint AS keys FROM p GROUP BY ALL""")
def split_one_pool(spark, d):
    """One pool without sources, dealt out to three samples in proportion 1 : 2 : 3."""
    asked = spark.range(1, 4).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sample"), F.col("id").alias("pos"), F.col("id").alias("req"))
    dealt = allocate.split_pool(I.table(spark, d, "orders").select("o_orderkey"), asked, [], ["o_orderkey"])
    return dealt.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


# taxonomy and other tables --------------------------------------------------


@query(f"WITH {_NODES} SELECT tax_id, parent, rank FROM nodes")
def taxonomy_lines(spark, d):
    nodes = I.nodes(spark, d)
    bad = spark.range(1).select(F.lit("x\t|\ty\t|\tspecies\t|").alias("value"))
    line = F.concat(F.col("tax_id").cast("string"), F.lit("\t|\t"), F.col("parent").cast("string"), F.lit("\t|\t"), "rank", F.lit("\t|"))
    return T.parse_nodes(text_lines(spark, nodes.select(line.alias("value")).unionByName(bad)))


@query("SELECT p_partkey::varchar AS taxid, (p_partkey % 25 + 100)::varchar AS mapped FROM part")
def rank_table_lines(spark, d):
    """Lines split by pipe, tab or comma, with comments and a header."""
    taxid, mapped = F.concat(F.col("p_partkey").cast("string"), F.lit(".0")), (F.col("p_partkey") % 25 + 100).cast("string")
    line = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws("|", taxid, mapped)).when(F.col("p_partkey") % 3 == 1, F.concat_ws("\t", taxid, mapped)).otherwise(F.concat_ws(",", taxid, mapped))
    extra = spark.range(2).select(F.when(F.col("id") == 0, "# comment 1,2").otherwise("taxid|genus").alias("value"))
    return T.parse_rank_table(text_lines(spark, I.table(spark, d, "part").select(line.alias("value")).unionByName(extra)))


@query("SELECT c_custkey::varchar AS taxid, c_name || '|' || c_mktsegment AS name FROM customer WHERE c_custkey <> 0")
def name_table_lines(spark, d):
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    return T.parse_name_table(text_lines(spark, I.table(spark, d, "customer").select(line.alias("value"))))


@query("SELECT (n_nationkey + 100)::bigint AS k, n_name AS name FROM nation")
def map_files(spark, d):
    path = new_path(spark)
    n = I.table(spark, d, "nation").select((F.col("n_nationkey") + 100).cast("string").alias("k"), "n_name")
    K.write_map(n, "k", "n_name", path)
    return T.parse_name_table(spark.read.text(path)).select(F.col("taxid").cast("long").alias("k"), "name")


@query("SELECT doc_id::varchar AS read_id, length(text)::int AS length, CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE 1.25 END::double AS gc FROM documents WHERE text IS NOT NULL")
def feature_files(spark, d):
    path = new_path(spark) + ".tsv"
    rows = I.table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("read_id"), F.length("text").alias("length"), F.when(F.col("doc_id") % 2 == 0, 0.5).otherwise(1.25).alias("gc"))
    K.write_features(rows, path)
    assert T.read_features(spark, path + ".none") is None
    return T.read_features(spark, path).select(F.col("read_id").cast("string").alias("read_id"), "length", "gc")


def _name_in(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


@query("SELECT s_suppkey::varchar AS sample, s_suppkey || '_R1.fastq' AS r1, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || '_R2.fastq' END AS r2 FROM supplier WHERE s_suppkey % 5 <> 0")
def fastq_catalogue(spark, d):
    """Paired read files that stand in a folder, with other files between them."""
    s = I.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("k"), "s_suppkey", F.lit("x").alias("line"))
    folder = new_path(spark)
    for part, ending, rows in (("a", "_R1.fastq", s.where("s_suppkey % 5 <> 0")), ("b", "_R2.fastq", s.where("s_suppkey % 2 = 0")), ("c", ".txt", s)):
        write_named(rows, F.col("k"), ending, ["line"], f"{folder}/{part}", drop=["k", "s_suppkey"])
    found = T.catalogue_fastq(T.list_files(spark, folder))
    return found.select("sample", _name_in(F.col("r1")).alias("r1"), _name_in(F.col("r2")).alias("r2"))


@query("SELECT p_size::varchar AS taxid, p_size || '.fna' AS file FROM part GROUP BY p_size UNION ALL SELECT '0' || p_size, '0' || p_size || '.faa' FROM part WHERE p_size % 3 = 0 GROUP BY p_size")
def genome_files(spark, d):
    """Sequence files that stand in a folder: those whose stem is a number."""
    sizes = I.table(spark, d, "part").select(F.col("p_size").cast("string").alias("k"), "p_size", F.lit(">x").alias("line")).distinct()
    folder = new_path(spark)
    for part, stem, ending, rows in (("a", F.col("k"), ".fna", sizes), ("b", F.concat(F.lit("0"), "k"), ".faa", sizes.where("p_size % 3 = 0")), ("c", F.concat(F.lit("x"), "k"), ".fa", sizes), ("d", F.col("k"), ".csv", sizes)):
        write_named(rows, stem, ending, ["line"], f"{folder}/{part}", drop=["k", "p_size"])
    return T.catalogue_genomes(T.list_files(spark, folder)).select("taxid", _name_in(F.col("path")).alias("file"))


@query("""SELECT taxid, path FROM (SELECT *, row_number() OVER (PARTITION BY taxid ORDER BY p, path) AS r FROM (
    SELECT cast(p_size AS varchar) AS taxid, p_partkey % 3 AS p, '/g/' || p_partkey || '/' || p_size || CASE p_partkey % 3 WHEN 0 THEN '.fna' WHEN 1 THEN '.fa' ELSE '.fasta.gz' END AS path FROM part)) WHERE r = 1""")
def genome_priority(spark, d):
    kind = F.col("p_partkey") % 3
    ending = F.when(kind == 0, ".fna").when(kind == 1, ".fa").otherwise(".fasta.gz")
    files = I.table(spark, d, "part").select(F.concat(F.lit("/g/"), F.col("p_partkey").cast("string"), F.lit("/"), F.col("p_size").cast("string"), ending).alias("path"))
    return T.genome_by_priority(T.catalogue_genomes(files)).select("taxid", "path")


# sequence files -------------------------------------------------------------


@query(f"WITH {_CONTIGS} SELECT header, md5(sequence) AS sequence_md5 FROM contigs")
def fasta_files(spark, d):
    """Records written gzipped and read again."""
    path = new_path(spark)
    K.write_fasta(I.contigs(spark, d), path, gzip=True)
    return seqio.read_fasta(spark, path).select("header", F.md5("sequence").alias("sequence_md5"))


@query(f"WITH {_CONTIGS} SELECT header AS id, taxid, file AS genome FROM contigs")
def sequence_map_files(spark, d):
    path = new_path(spark)
    K.write_sequence_map(I.contigs(spark, d).select(F.col("header").alias("id"), "taxid", F.col("file").alias("genome")), path)
    return spark.read.csv(path, sep="\t", schema="id string, taxid string, genome string")


@query(f"WITH {_LETTERS} SELECT read_id, md5(seq) AS seq_1, md5(reverse(seq)) AS seq_2, md5('@' || substr(lower(seq), 2)) AS qual_1 FROM letters WHERE seq <> ''")
def fastq_pairs(spark, d):
    """Both mates written as FASTQ, read again in small byte ranges and put side by side by their place in each pair of files; every quality line begins with '@'."""
    reads = I.letters(spark, d).where("seq <> ''")
    both = reads.select("read_id", F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.col("seq").alias("s")), F.struct(F.lit(2).alias("mate"), F.reverse("seq").alias("s")))).alias("m"))
    qual = F.concat(F.lit("@"), F.lower(F.expr("substr(m.s, 2)")))
    rows = both.select("read_id", "m.mate", F.concat_ws("/", "read_id", F.col("m.mate").cast("string")).alias("header"), F.col("m.s").alias("seq"), qual.alias("qual"))
    path = new_path(spark)
    K.write_fastq(rows.sortWithinPartitions("mate", "read_id"), path)
    sides = [seqio.read_fastq(spark, f"{path}/mate={m}", m, range_bytes=1 << 18).withColumn("pair", F.regexp_extract("file", r"part-(\d+)", 1)) for m in (1, 2)]
    out = seqio.pair_mates(*sides, keys=("pair", "ord"))
    return out.select(F.regexp_replace("header_1", "/1$", "").alias("read_id"), F.md5("seq_1").alias("seq_1"), F.md5("seq_2").alias("seq_2"), F.md5("qual_1").alias("qual_1"))


@query(f"WITH {_LETTERS} SELECT read_id, length(seq)::int AS n FROM letters WHERE seq <> ''")
def pooled_reads(spark, d):
    reads = I.letters(spark, d).select("doc_id", "read_id", F.col("read_id").alias("header"), "seq")
    pools = reads.where("doc_id % 2 = 0"), reads.where("doc_id % 2 <> 0").withColumn("pool", F.lit("host"))
    return seqio.pool_reads(*pools).select("read_id", F.length("seq").alias("n"))


@query(f"WITH {_CONTIGS} SELECT taxid, contig_no, coalesce(sum(length(sequence) + 500) OVER (PARTITION BY taxid ORDER BY contig_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start, md5(sequence) AS sequence_md5 FROM contigs")
def genome_pieces(spark, d):
    return sequences.genome_pieces(I.contigs(spark, d)).select("taxid", "contig_no", "start", F.md5("sequence").alias("sequence_md5"))


_CDS = _CONTIGS + f""", ex AS (SELECT contig_no, taxid, contig_no % 2 AS minus, substr(sequence, 1, 30) AS a, substr(sequence, 41, 260) AS b FROM contigs WHERE length(sequence) >= 300),
    ori AS (SELECT contig_no, taxid, CASE WHEN minus = 0 THEN a || substr(b, 2) ELSE substr(reverse(translate(b, 'ACGT', 'TGCA')), 2) || reverse(translate(a, 'ACGT', 'TGCA')) END AS s FROM ex),
    tr AS (SELECT contig_no, taxid, array_to_string(list_transform(range(0, length(s) // 3), lambda i: coalesce({_CODONS}[substr(s, i * 3 + 1, 3)], 'X')), '') AS aa FROM ori),
    cds AS (SELECT 'p' || contig_no AS protein_id, taxid, replace(string_split(aa, '*')[1], 'X', '') AS aa FROM tr WHERE length(replace(string_split(aa, '*')[1], 'X', '')) >= 10)"""


def _coding(spark: SparkSession, d: str) -> DataFrame:
    """Coding sequences of two parts each, from feature lines of a file; one in fifty seqids is only part of a contig's id."""
    contigs = materialize(I.contigs(spark, d).where(F.length("sequence") >= 300).withColumn("header", F.concat(F.lit("ctg_"), F.col("contig_no").cast("string"), F.lit("_end more"))))
    strand = F.when(F.col("contig_no") % 2 == 0, "+").otherwise("-")
    name = F.col("contig_no").cast("string")
    seqid = F.when(F.col("contig_no") % 50 == 0, F.concat(F.lit("_"), name, F.lit("_"))).otherwise(F.concat(F.lit("ctg_"), name, F.lit("_end")))
    line = lambda start, end, phase, attrs: joined(seqid, F.lit("x"), F.lit("CDS"), F.lit(start), F.lit(end), F.lit("."), strand, F.lit(phase), attrs)
    plain = F.concat(F.lit("protein_id=p"), name, F.lit(";note=a"))
    quoted = F.concat(F.lit('gene_id "g"; protein_id "p'), name, F.lit('";'))
    lines = contigs.select(line("1", "30", "0", plain)).unionByName(contigs.select(line("41", "300", "1", quoted)))
    lines = lines.unionByName(spark.range(2).select(F.when(F.col("id") == 0, "# comment").otherwise("too\tfew").alias("value")))
    return sequences.coding_sequences(T.parse_gff(text_lines(spark, lines)), contigs)


@query(f"WITH {_CDS} SELECT protein_id, aa FROM cds")
def coding_proteins(spark, d):
    return _coding(spark, d).select("protein_id", "aa")


@query(f"WITH {_CDS} SELECT protein_id, aa FROM cds WHERE length(aa) >= 30")
def clean_proteins(spark, d):
    return sequences.clean_proteins(_coding(spark, d).withColumn("aa", F.concat("aa", F.lit("*X")))).select("protein_id", "aa")
