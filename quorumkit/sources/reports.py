"""Classifier reports: one scan for all tools, into one long table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The long form of every report.
REPORT = T.StructType([T.StructField(n, T.StringType()) for n in ("sample", "tool")] + [T.StructField("run_idx", T.IntegerType())] + [T.StructField(n, T.StringType()) for n in ("seq", "taxid", "length")] + [T.StructField("line_no", T.LongType())])
#: Names by which tools are known in file names.
TOOL_ALIASES = {"krakenu": "krakenuniq", "krakenunique": "krakenuniq", "metaphlan4": "metaphlan", "mpa": "metaphlan", "mp4": "metaphlan", "kraken": "kraken1"}

Parser = Callable[[Column], dict[str, Column]]


def _nth(fields: Column, i: int) -> Column:
    return F.get(fields, F.lit(i))


def parse_kraken2(fields: Column) -> dict[str, Column]:
    """classified, seq, 'name (taxid N)', length 'a|b', k-mers. Without ``taxid N`` the label is 0."""
    taxid = F.regexp_extract(_nth(fields, 2), r"(?i)taxid ([0-9]+)", 1)
    return {"seq": _nth(fields, 1), "taxid": F.when(taxid == "", "0").otherwise(taxid), "length": F.substring_index(_nth(fields, 3), "|", 1), "least": F.lit(4), "name": F.regexp_replace(_nth(fields, 2), r" \(.*", "")}


def parse_kraken1(fields: Column) -> dict[str, Column]:
    """classified, seq, taxID, length, k-mers; also the layout of KrakenUniq."""
    return {"seq": _nth(fields, 1), "taxid": _nth(fields, 2), "length": F.substring_index(_nth(fields, 3), "|", 1), "least": F.lit(3)}


def parse_kaiju(fields: Column) -> dict[str, Column]:
    return {"seq": _nth(fields, 1), "taxid": _nth(fields, 2), "length": F.lit(None).cast("string"), "least": F.lit(3)}


def parse_custom(fields: Column) -> dict[str, Column]:
    """seq, taxID and a length where there is a third column."""
    return {"seq": _nth(fields, 0), "taxid": _nth(fields, 1), "length": _nth(fields, 2), "least": F.lit(2)}


def parse_metaphlan(fields: Column) -> dict[str, Column]:
    """seq and marker; the marker's number part is the label until it is mapped."""
    marker = F.regexp_extract(_nth(fields, 1), r"M\d+-c\d+", 0)
    return {"seq": _nth(fields, 0), "taxid": F.when(marker == "", _nth(fields, 1)).otherwise(marker), "length": F.lit(None).cast("string"), "least": F.lit(2)}


#: Tool -> parser; unknown tools are read as custom. ``register_parser`` adds to it.
PARSERS: dict[str, Parser] = {"kraken1": parse_kraken1, "kraken2": parse_kraken2, "krakenuniq": parse_kraken1, "kaiju": parse_kaiju, "metaphlan": parse_metaphlan}


def register_parser(tool: str, parser: Parser) -> None:
    PARSERS[tool] = parser


def tool_of_file(name: Column) -> Column:
    """Tool in ``*.<tool>.out``, also with ``.gz``; custom_ goes and aliases are folded; other names give null."""
    found = F.regexp_extract(name, r"\.([^./]+)\.out(?:\.gz)?$", 1)
    bare = F.regexp_replace(found, "^custom_", "")
    aliases = F.create_map(*(F.lit(x) for pair in TOOL_ALIASES.items() for x in pair))
    folded = F.when(found.startswith("custom_"), bare).otherwise(F.coalesce(F.try_element_at(aliases, bare), bare))
    return F.when(found == "", F.lit(None)).otherwise(folded)


def sample_of_file(name: Column, n_tokens: int = 1) -> Column:
    """First n tokens between underscores; names with fewer are taken whole, up to the tool."""
    stem = F.regexp_replace(name, r"\.[^.]+\.out(?:\.gz)?$", "")
    tokens = F.split(stem, "_")
    return F.when(F.size(tokens) < n_tokens, stem).otherwise(F.array_join(F.slice(tokens, 1, n_tokens), "_"))


def _fields_of(value: Column) -> Column:
    return F.split(F.rtrim(value, F.lit("\r")), "\t")


def parse_reports(lines: DataFrame) -> DataFrame:
    """Long report table from lines (sample, tool, run_idx, line_no, value).

    Carriage returns go; blank lines, lines with too few fields and lines
    without a read id are dropped. The tool decides how a line is read.
    """
    return _parse(lines.withColumn("fields", _fields_of(F.col("value"))))


def _parse(lines: DataFrame) -> DataFrame:
    fields = F.col("fields")
    parsed = {tool: parse(fields) for tool, parse in PARSERS.items()}
    other = parse_custom(fields)

    def pick(key: str) -> Column:
        chosen = F.lit(None)
        for tool, columns in parsed.items():
            chosen = F.when(F.col("tool") == tool, columns[key]) if chosen is None or tool == next(iter(parsed)) else chosen.when(F.col("tool") == tool, columns[key])
        return chosen.otherwise(other[key])

    out = lines.select("sample", "tool", "run_idx", pick("seq").alias("seq"), pick("taxid").alias("taxid"), pick("length").alias("length"), "line_no", F.size(fields).alias("n"), pick("least").alias("least"))
    return out.where((F.col("n") >= F.col("least")) & (F.col("seq") != "")).select("sample", "tool", "run_idx", "seq", "taxid", "length", "line_no")


def read_reports(spark: SparkSession, paths: str | list[str], n_tokens: int = 1) -> DataFrame:
    """Scan report files; sample, tool and run come from the file names. No files give no rows."""
    try:
        raw = spark.read.text(paths)
    except Exception as e:  # no such path
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], REPORT)
    lines = raw.select(_fields_of(F.col("value")).alias("fields"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line_no"))
    every = F.element_at(F.split("path", "/"), -1)
    listed = spark.read.format("binaryFile").load(paths).select("path").select(every.alias("file")).distinct()  # names alone; no file is opened
    files = listed.select(sample_of_file(F.col("file"), n_tokens).alias("sample"), tool_of_file(F.col("file")).alias("tool"), "file").where("tool IS NOT NULL")
    runs = files.withColumn("run_idx", F.row_number().over(Window.partitionBy("sample", "tool").orderBy("file")) - 1)
    return _parse(lines.join(F.broadcast(runs), "file"))  # a row for each file, which the driver lists anyway; lines stay where they are read


def read_sam(lines: DataFrame) -> DataFrame:
    """(seq, contig) of alignment lines; header lines start with @."""
    f = F.split("value", "\t")
    return lines.where(~F.col("value").startswith("@") & (F.size(f) >= 3)).select(_nth(f, 0).alias("seq"), _nth(f, 2).alias("contig"))


def read_centrifuge(lines: DataFrame) -> DataFrame:
    """(seq, taxid) of classified reads of a report whose first line is a header."""
    f = F.split("value", "\t")
    return lines.select(_nth(f, 0).alias("seq"), _nth(f, 2).alias("taxid")).where((F.col("taxid") != "0") & (F.col("seq") != "readID"))


def map_contig_labels(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """Read labels through contig labels (contig, taxid): unmapped reads and label 0 go."""
    return alignments.where("contig <> '*'").join(contigs.where("taxid <> '0'"), "contig").select("seq", "taxid")


def parse_marker_map(lines: DataFrame) -> DataFrame:
    """(ref_id, tax_id) of an exported marker table: tab- or comma-separated lines; a header and lines without a numeric label go."""
    f = F.split("value", "[\t,]")
    return lines.select(F.trim(_nth(f, 0)).alias("ref_id"), F.trim(_nth(f, 1)).alias("tax_id")).where("tax_id RLIKE '^[0-9]+$'")


def map_markers(report: DataFrame, markers: DataFrame, unmapped: str | None = None) -> DataFrame:
    """Marker ids of MetaPhlAn rows to labels (ref_id, tax_id); others stay."""
    joined = report.join(markers.select(F.col("ref_id").alias("taxid"), "tax_id"), "taxid", "left")
    label = F.when(F.col("tool") == "metaphlan", F.coalesce("tax_id", F.lit(unmapped).cast("string"))).otherwise(F.col("taxid"))
    return joined.withColumn("taxid", label).select(*report.columns)


def constant_report(reads: DataFrame, taxid: str = "9606") -> DataFrame:
    """One label for every distinct read id of all mates."""
    return reads.select(F.col("read_id").alias("seq")).dropDuplicates().withColumn("taxid", F.lit(taxid))
