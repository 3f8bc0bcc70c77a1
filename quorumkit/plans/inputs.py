"""Votes, reports, trees and sequences derived from the given tables.

The SQL texts are written once, in the subset that Spark and DuckDB share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANNOTATORS = ("taxID_a_0", "taxID_b_0", "taxID_c_0")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "embeddings")

#: One read per line item: its truth is the supplier's nation, three annotators vote with plain arithmetic.
CALLS = """
SELECT concat(cast(l_orderkey AS varchar(20)), '_', cast(l_linenumber AS varchar(20)), '_', cast(l_partkey AS varchar(20)), '_', cast(l_suppkey AS varchar(20))) AS seq,
       l_returnflag AS sample,
       cast(100 + s_nationkey AS varchar(20)) AS `true`,
       cast(CASE WHEN l_discount < 0.06 THEN 100 + s_nationkey WHEN l_tax < 0.02 THEN 0 ELSE 100 + c_nationkey END AS varchar(20)) AS `taxID_a_0`,
       cast(CASE WHEN l_tax < 0.04 THEN 100 + s_nationkey WHEN l_quantity < 10 THEN 0 ELSE 100 + c_nationkey END AS varchar(20)) AS `taxID_b_0`,
       cast(CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN l_quantity > 25 THEN 100 + s_nationkey ELSE 100 + c_nationkey END AS varchar(20)) AS `taxID_c_0`,
       cast(cast(l_quantity AS int) AS varchar(20)) AS length,
       l_discount AS confidence,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {supplier} ON l_suppkey = s_suppkey
"""

NODES = """
SELECT cast(100 + n_nationkey AS bigint) AS tax_id, cast(10 + n_regionkey AS bigint) AS parent, 'species' AS rank FROM {nation}
UNION ALL SELECT cast(10 + r_regionkey AS bigint), cast(1 AS bigint), 'genus' FROM {region}
UNION ALL SELECT cast(1000 + p_partkey AS bigint), cast(100 + p_partkey % 25 AS bigint), 'strain' FROM {part}
UNION ALL SELECT cast(1 AS bigint), cast(1 AS bigint), 'no rank'
"""

#: Report lines of two tools over the same reads; order and line alone name a read, so some ids repeat.
LINES = """
SELECT sample, 'kaiju' AS tool, 0 AS run_idx, cast(((l_partkey * 100003 + l_suppkey) * 64 + l_quantity) * 32 + round(l_discount * 100) AS bigint) AS line_no,
       concat('C', chr(9), cast(l_orderkey AS varchar(20)), '_', cast(l_linenumber AS varchar(20)), '|taxid:', `true`, chr(9), `taxID_a_0`) AS value FROM calls WHERE l_linenumber % 5 <> 0
UNION ALL
SELECT sample, 'kraken2', 0, cast(((l_partkey * 100003 + l_suppkey) * 64 + l_quantity) * 32 + round(l_discount * 100) AS bigint),
       concat('C', chr(9), cast(l_orderkey AS varchar(20)), '_', cast(l_linenumber AS varchar(20)), '|taxid:', `true`, chr(9), 'name (taxid ', `taxID_b_0`, ')', chr(9), length, '|', length, chr(9), 'k:1') FROM calls WHERE l_linenumber % 7 <> 0
"""


def duck(sql: str) -> str:
    """The shared text as DuckDB reads it: table names bare, quotes double."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql.replace("`", '"')


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    for name, frame in frames.items():
        sql = sql.replace(f" {name} ", f" {{{name}}} ")
    return spark.sql(sql, **used, **frames)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, CALLS)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, NODES)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, LINES, calls=calls(spark, sf_dir))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long votes: sample, seq, true, annotator, label."""
    return calls(spark, sf_dir).unpivot(["sample", "seq", "true"], list(ANNOTATORS), "annotator", "label")


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document as upper-case letters: read_id, seq, qual."""
    docs = table(spark, sf_dir, "documents")
    seq = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    return docs.select(F.col("doc_id").cast("string").alias("read_id"), seq.alias("seq"), seq.alias("qual"), "lang", "source", "doc_id")


#: Letters to bases, in DuckDB and Spark alike.
BASES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document as a nucleotide contig of the genome of its source."""
    reads = letters(spark, sf_dir)
    return reads.select(F.col("source").alias("file"), F.regexp_replace("source", "[^0-9]", "").alias("taxid"), F.col("doc_id").alias("contig_no"), F.col("read_id").alias("header"), F.translate("seq", *BASES).alias("sequence")).where("sequence <> ''")


def events_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types per user bucket as a second abundance table."""
    e = table(spark, sf_dir, "events").where("event_type IS NOT NULL AND user_id IS NOT NULL")
    bucket = (F.col("user_id") % 12).cast("string")
    return e.groupBy(F.lit("events").alias("annotator"), bucket.alias("sample"), F.col("event_type").alias("taxid")).agg(F.count(F.lit(1)).alias("n"))
