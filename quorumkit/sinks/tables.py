"""Writers; each takes a table in its long or wide form and a folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumkit.sinks.named import write_named


def write_votes(wide: DataFrame, path: str) -> None:
    """Vote tables as <sample>.annotation.csv, sorted by read id, without the sample column."""
    write_named(wide, F.col("sample"), ".annotation.csv", ["seq"], path, drop=["sample"])


def safe_file_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_")


def write_abundance(abundance: DataFrame, samples: Sequence[str], path: str) -> None:
    """label x sample tables as <annotator>.csv, sorted by label."""
    wide = abundance.groupBy("annotator", "taxid").pivot("sample", list(samples)).sum("n").fillna(0)
    wide = wide.select("annotator", "taxid", *(F.col(f"`{s}`").alias(f"N_{s}") for s in samples))
    write_named(wide, F.col("annotator"), ".csv", ["taxid"], path, drop=["annotator"])


def write_pooled(pooled: DataFrame, path: str) -> None:
    """All samples as combined_annotation_table.csv, one file of any size."""
    write_named(pooled, F.lit("combined_annotation_table"), ".csv", ["sample", "seq"], path)


def write_reprofiled(scored: DataFrame, path: str) -> None:
    """Corrected votes as <sample>_reprofiled.csv, sorted by read id, without the sample column."""
    write_named(scored, F.concat(F.coalesce("sample", F.lit("")), F.lit("_reprofiled")), ".csv", ["seq"], path, drop=["sample"])


def map_lines(table: DataFrame, key: str, value: str) -> DataFrame:
    """'key|value' lines: label 0 dropped, pipes in values replaced, shorter keys first."""
    rows = table.where(F.col(key) != "0").select(F.col(key).alias("k"), F.replace(F.col(value), F.lit("|"), F.lit("/")).alias("v")).distinct()
    return rows.orderBy(F.length("k"), "k", "v").select(F.concat_ws("|", "k", "v").alias("value"))


def write_map(table: DataFrame, key: str, value: str, path: str) -> None:
    map_lines(table, key, value).coalesce(1).write.mode("overwrite").text(path)


def fasta_lines(records: DataFrame) -> DataFrame:
    return records.select(F.concat(F.lit(">"), F.col("header"), F.lit("\n"), F.col("sequence")).alias("value"))


def write_fasta(records: DataFrame, path: str, gzip: bool = False) -> None:
    fasta_lines(records).write.mode("overwrite").text(path, compression="gzip" if gzip else "none")


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("header")), F.col("seq"), F.lit("+"), F.col("qual")).alias("value"))


def write_fastq(reads: DataFrame, path: str, gzip: bool = False) -> None:
    """Reads of each mate in a folder of its own; no reads give an empty folder."""
    lines = reads.select("mate", F.concat_ws("\n", F.concat(F.lit("@"), F.col("header")), F.col("seq"), F.lit("+"), F.col("qual")).alias("value"))
    lines.write.mode("overwrite").partitionBy("mate").text(path, compression="gzip" if gzip else "none")


def write_read_counts(plan: DataFrame, path: str) -> int:
    """'id<TAB>n' lines of positive counts; returns their sum."""
    positive = plan.where("n > 0").select("source", F.col("n").cast("long").alias("n"))
    positive.write.mode("overwrite").csv(path, sep="\t")
    return positive.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_sequence_map(records: DataFrame, path: str) -> None:
    records.select("id", "taxid", "genome").write.mode("overwrite").csv(path, sep="\t")


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_report(report: DataFrame, path: str) -> None:
    report.select("seq", "taxid").write.mode("overwrite").csv(path, sep="\t")
