"""FASTA and FASTQ files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumkit.sources import records


def _with_places(records: DataFrame, name: str) -> DataFrame:
    """Replace block and at by a record's place in its file (from 0): its number in its range and the records of all ranges before.

    Only the number of records of each range is added up; records stay where they are read.
    """
    sizes = records.groupBy("file", "block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return records.join(starts, ["file", "block"]).withColumn(name, F.col("__start") + F.col("at")).drop("__start", "block", "at")


def read_fasta(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(file, contig_no, header, sequence) of files, folders or patterns; blank lines go, wrapped sequences are joined.

    A plain file is read by many tasks, a gzip file by one that streams it.
    """
    rows = _with_places(records.load(spark, records.FastaSource, paths, range_bytes), "contig_no")
    return rows.select("file", F.col("contig_no").cast("int").alias("contig_no"), "header", "sequence")


def fastq_records(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(file, block, at, header, seq, qual): records as they are read, without any exchange; (block, at) orders those of a file."""
    return records.load(spark, records.FastqSource, paths, range_bytes)


def read_fastq(spark: SparkSession, paths: str | list[str], mate: int = 1, range_bytes: int | None = None) -> DataFrame:
    """(file, ord, mate, read_id, header, seq, qual); a truncated last record is dropped."""
    rows = _with_places(fastq_records(spark, paths, range_bytes), "ord")
    read_id = F.regexp_replace(F.substring_index("header", " ", 1), "/[12]$", "")
    return rows.select("file", "ord", F.lit(mate).alias("mate"), read_id.alias("read_id"), "header", "seq", "qual")


def pair_mates(r1: DataFrame, r2: DataFrame, keys: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Mates side by side by their place; blank headers are dropped and the shorter side ends it.

    With several files a side, ``keys`` also names the column that tells which files are a pair.
    """
    pick = lambda df, n: df.where(F.trim("header") != "").select(*keys, *(F.col(c).alias(f"{c}_{n}") for c in ("header", "seq", "qual")))
    return pick(r1, 1).join(pick(r2, 2), list(keys))


def sort_reads(reads: DataFrame, parts: int | None = None) -> DataFrame:
    """Reads in the order of their ids, each mate for itself."""
    keys = ["mate", "read_id"]
    ranged = reads.repartitionByRange(parts, *keys) if parts else reads.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def pool_reads(*reads: DataFrame) -> DataFrame:
    """All reads of several pools; blank records are left out."""
    out = reads[0]
    for more in reads[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.where((F.trim("header") != "") & (F.col("seq") != ""))
