"""Text tables: taxonomy, translation tables, features, genes and pooled votes."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quorumkit.functions.labels import canonical_label, coalesce_same_names

#: Endings of sequence files and which of them hold nucleotides.
NUCLEOTIDE_ENDINGS, PROTEIN_ENDINGS = ("fna", "fa", "fasta", "ffn"), ("faa",)
FASTA_NAME = r"\.(fna|fa|fasta|ffn|faa)(\.gz)?$"
#: Which file is taken as a genome first.
GENOME_PRIORITY = ("fna", "fna.gz", "fa", "fa.gz", "fasta", "fasta.gz")


def parse_nodes(lines: DataFrame) -> DataFrame:
    """(tax_id, parent, rank) of taxonomy dump lines; lines with bad ids are skipped."""
    f = F.split("value", r"\t\|\t")
    number = lambda i: F.trim(F.get(f, F.lit(i))).try_cast("long")
    rank = F.trim(F.regexp_replace(F.get(f, F.lit(2)), r"[\t|]+$", ""))
    return lines.select(number(0).alias("tax_id"), number(1).alias("parent"), rank.alias("rank")).where("tax_id IS NOT NULL AND parent IS NOT NULL")


def parse_rank_table(lines: DataFrame) -> DataFrame:
    """(taxid, mapped) of lines split by pipe, else tab, else comma; comments and headers are skipped."""
    v = F.trim("value")
    sep = F.when(v.contains("|"), r"\|").when(v.contains("\t"), "\t").otherwise(",")
    f = F.split(v, sep)
    out = lines.where((v != "") & ~v.startswith("#")).select(F.trim(F.get(f, F.lit(0))).alias("taxid"), F.trim(F.get(f, F.lit(1))).alias("mapped"))
    return out.where("mapped IS NOT NULL AND taxid RLIKE '[0-9]'").select(canonical_label(F.col("taxid")).alias("taxid"), canonical_label(F.col("mapped")).alias("mapped"))


def parse_name_table(lines: DataFrame) -> DataFrame:
    """(taxid, name) of lines split at their first pipe."""
    f = F.split("value", r"\|", 2)
    return lines.where(F.size(f) == 2).select(canonical_label(F.get(f, F.lit(0))).alias("taxid"), F.trim(F.get(f, F.lit(1))).alias("name")).where("taxid <> '0'")


def gff_attributes(text: Column) -> Column:
    """Map of ``k=v;`` or ``k "v";`` attributes."""
    unquoted = F.regexp_replace(F.regexp_replace(text, r'\s*;\s*$', ""), r'([A-Za-z0-9_]+) "([^"]*)"', "$1=$2")
    return F.str_to_map(F.regexp_replace(unquoted, r"\s*;\s*", ";"), F.lit(";"), F.lit("="))


def parse_gff(lines: DataFrame) -> DataFrame:
    """Gene features; comments and lines with fewer than nine fields are dropped."""
    f = F.split("value", "\t")
    at = lambda i: F.get(f, F.lit(i))
    rows = lines.where(~F.col("value").startswith("#") & (F.size(f) >= 9))
    return rows.select(at(0).alias("seqid"), at(2).alias("type"), at(3).try_cast("long").alias("start"), at(4).try_cast("long").alias("end"), at(6).alias("strand"), at(7).try_cast("int").alias("phase"), gff_attributes(at(8)).alias("attrs"))


def read_features(spark: SparkSession, path: str) -> DataFrame | None:
    """Per-read features; tab for .tsv and .txt, else comma; a missing file gives None."""
    try:
        return spark.read.csv(path, sep="\t" if path.endswith((".tsv", ".txt")) else ",", header=True, inferSchema=True)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def list_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(path) of the files below folders whose names match a pattern; none of them is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(paths).select("path")


def read_pooled(spark: SparkSession, paths: str | list[str], sample_position: int = 0) -> DataFrame | None:
    """Row-wise union of per-sample vote tables with a ``sample`` column; None without any.

    ``paths`` are files or folders. Pooled tables are skipped, column names
    normalised, same names coalesced. One job finds the header of every file,
    then files with equal headers are one scan, whose columns are known.
    """
    if not paths:
        return None
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where(~F.col("name").startswith("combined_annotation_table") & (F.col("block") == 0)).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").collect():  # a line for each file, as the listing has
        by_header.setdefault(tuple(next(csv.reader([r["header"]]), ())), []).append(r["file"])
    tokens = F.split("__file", r"\.")
    out = None
    for header, group in by_header.items():
        names = [f"{c}...{i}" if c in header[:i] else c for i, c in enumerate(header)]  # a repeated name, which its ending tells apart
        df = spark.read.schema(StructType([StructField(c, StringType()) for c in names])).csv(group, header=True)
        df = df.select("*", F.col("_metadata.file_name").alias("__file"))
        df = coalesce_same_names(df).withColumn("sample", F.array_join(F.slice(tokens, 1, sample_position + 1), "_")).drop("__file")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def catalogue_genomes(files: DataFrame) -> DataFrame:
    """(path, taxid) of sequence files (path): those whose stem is a number."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_extract(name, r"^(\d+)\.(?:fna|fa|fasta|ffn|faa)(?:\.gz)?$", 1)
    return files.where(name.rlike(FASTA_NAME)).select("path", stem.alias("taxid")).where("taxid <> ''")


def _ending(path: Column) -> Column:
    return F.regexp_extract(path, r"\.((?:fna|fa|fasta|ffn|faa)(?:\.gz)?)$", 1)


def one_file_per_label(catalogue: DataFrame) -> DataFrame:
    """Nucleotide files before protein files, then the first path."""
    nucleotide = F.regexp_replace(_ending(F.col("path")), r"\.gz$", "").isin(*NUCLEOTIDE_ENDINGS)
    by = Window.partitionBy("taxid").orderBy(nucleotide.desc(), "path")
    return catalogue.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")


def genome_by_priority(catalogue: DataFrame) -> DataFrame:
    """The file of each label that stands first in GENOME_PRIORITY."""
    place = F.array_position(F.array(*map(F.lit, GENOME_PRIORITY)), _ending(F.col("path")))
    by = Window.partitionBy("taxid").orderBy("__p", "path")
    return catalogue.withColumn("__p", place).where("__p > 0").withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n", "__p")


def catalogue_fastq(files: DataFrame) -> DataFrame:
    """(sample, r1, r2) of paired read files named <sample>_R1.fastq[.gz] or .fq; r2 may be null."""
    name = F.element_at(F.split("path", "/"), -1)
    mate = F.regexp_extract(name, r"_R([12])\.(?:fastq|fq)(?:\.gz)?$", 1)
    named = files.select("path", mate.alias("mate"), F.regexp_replace(name, r"_R[12]\.(fastq|fq)(\.gz)?$", "").alias("sample")).where("mate <> ''")
    pairs = named.groupBy("sample").agg(F.min(F.when(F.col("mate") == "1", F.col("path"))).alias("r1"), F.min(F.when(F.col("mate") == "2", F.col("path"))).alias("r2"))
    return pairs.where("r1 IS NOT NULL")
