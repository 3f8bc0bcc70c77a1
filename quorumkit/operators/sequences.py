"""Row emitters over sequence tables: parts, frames, open reading frames, coding sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumkit.functions import sequence as S
from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize

#: Fixed value: unknown bases between the contigs of one genome.
SPACER = 500


def read_features(reads: DataFrame, key: str = "read_id", seq: str = "seq", qual: str | None = "qual") -> DataFrame:
    """One row of scalar features per read. Empty reads have null shares and zero counts."""
    has_quality = bool(qual) and qual in reads.columns
    s = F.upper(F.col(seq))
    own = reads.select(F.col(key).alias("read_id"), s.alias("s"), S.text_statistics(s, F.col(qual) if has_quality else F.lit(None).cast("string")).alias("x"))
    s = F.col("s")
    return own.select(
        "read_id",
        F.length(s).alias("length"),
        S.gc_content(s).alias("gc"),
        S.skew(s, "G", "C").alias("gc_skew"),
        S.skew(s, "A", "T").alias("at_skew"),
        "x.shannon",
        "x.renyi2",
        "x.min_entropy",
        "x.ling_complexity",
        "x.repeat_frac",
        "x.dust",
        "x.mean_qual",
    )


def split_contigs(contigs: DataFrame, percent: float) -> DataFrame:
    """Parts of each contig with the header <taxid>|taxid:<taxid>|contig|part."""
    rows = contigs.select("file", "taxid", "contig_no", F.posexplode(S.parts(F.col("sequence"), F.lit(percent))).alias("part_no", "sequence"))
    header = F.concat_ws("|", "taxid", F.concat(F.lit("taxid:"), F.col("taxid")), F.col("contig_no").cast("string"), F.col("part_no").cast("string"))
    return rows.withColumn("header", header)


def mutate_sequences(contigs: DataFrame, rate: float, seed: int = 42) -> DataFrame:
    return contigs.withColumn("sequence", S.mutate(F.col("sequence"), F.col("header"), rate, seed))


def _frames(contigs: DataFrame, unknown: str = "X") -> DataFrame:
    strand = F.explode(F.array(F.struct(F.lit(1).alias("strand"), F.col("sequence").alias("s")), F.struct(F.lit(-1).alias("strand"), S.reverse_complement(F.col("sequence")).alias("s"))))
    both = contigs.select("file", "taxid", "contig_no", strand.alias("x")).select("file", "taxid", "contig_no", "x.strand", "x.s")
    each = both.withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return each.select("file", "taxid", "contig_no", "strand", "frame", S.translate(F.substr("s", F.col("frame") + 1), unknown).alias("aa"))


def six_frames(contigs: DataFrame) -> DataFrame:
    """Six-frame translations, stops as X, with ids c<contig>s<strand>f<frame>."""
    name = F.concat(F.lit("c"), F.col("contig_no").cast("string"), F.lit("s"), F.col("strand").cast("string"), F.lit("f"), F.col("frame").cast("string"))
    return _frames(contigs).select("file", "taxid", name.alias("id"), F.replace("aa", F.lit("*"), F.lit("X")).alias("aa"))


def open_reading_frames(contigs: DataFrame, min_aa: int = 15) -> DataFrame:
    """Stretches between stops of all six frames, without X, of at least ``min_aa``; numbered per file."""
    pieces = _frames(contigs).select("file", "taxid", "contig_no", "strand", "frame", F.posexplode(F.split("aa", r"\*")).alias("k", "raw"))
    kept = pieces.withColumn("aa", F.replace("raw", F.lit("X"), F.lit(""))).where(F.length("aa") >= min_aa)
    kept = materialize(kept)  # ranges are drawn from it first
    numbered = running_sum(kept, ["file"], ["contig_no", F.desc("strand"), "frame", "k"], name="orf_no")
    return numbered.select("file", "taxid", F.col("orf_no").cast("int").alias("orf_no"), "aa")


#: Characters of a gram of the substring index.
GRAM = 4


def _grams(text: Column, size: Column) -> Column:
    """Distinct runs of ``size`` characters; a shorter text has none."""
    last = F.length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, size)))).otherwise(F.array().cast("array<string>"))


def containing(wanted: DataFrame, part: str, texts: DataFrame, text: str) -> DataFrame:
    """Rows of ``wanted`` with each row of ``texts`` whose ``text`` contains their ``part``.

    An inverted index instead of a nested loop: texts are found by their grams
    of ``GRAM`` characters, a part asks for its rarest gram alone, and what comes
    back is compared in full. Parts shorter than a gram ask for themselves, in
    an index of that size. Empty and null parts find nothing.
    """
    probes = wanted.select(F.col(part).alias("__part")).where("__part <> ''").distinct().withColumn("__size", F.least(F.length("__part"), F.lit(GRAM)))
    sizes = sorted(r["__size"] for r in probes.select("__size").distinct().collect())  # at most GRAM
    if not sizes:
        return wanted.join(texts, F.lit(False))
    keys = texts.select(F.col(text).alias("__text")).distinct()
    index = keys.select("__text", F.explode(F.array(*map(F.lit, sizes))).alias("__size")).select("__text", "__size", F.explode(_grams(F.col("__text"), F.col("__size"))).alias("__gram"))
    asked = probes.select("__part", "__size", F.explode(_grams(F.col("__part"), F.col("__size"))).alias("__gram"))
    index = index.join(asked.select("__gram").distinct(), "__gram", "left_semi")
    counts = index.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rare = asked.join(counts, "__gram", "left").groupBy("__part").agg(F.min_by("__gram", F.struct(F.coalesce("__n", F.lit(0)), "__gram")).alias("__gram"))
    found = rare.join(index.select("__gram", "__text"), "__gram").where(F.contains("__text", "__part")).select("__part", "__text")
    return wanted.join(found, F.col(part) == F.col("__part")).drop("__part").join(texts, F.col(text) == F.col("__text")).drop("__text")


def coding_sequences(features: DataFrame, contigs: DataFrame, min_aa: int = 10) -> DataFrame:
    """Proteins of CDS features: protein_id, aa.

    Parts are joined to contigs by id; a seqid that equals none takes the first
    contig that contains it, and a protein with a part still without a contig is
    dropped. Parts go by start (descending on '-'), each trimmed by its phase,
    and are translated up to the first stop.
    """
    attr = lambda k: F.try_element_at("attrs", F.lit(k))
    pid = F.coalesce(attr("protein_id"), attr("ID"), attr("Parent"))
    cds = features.where("type = 'CDS'").withColumn("protein_id", pid).where("protein_id IS NOT NULL")
    named = contigs.select(F.substring_index("header", " ", 1).alias("contig"), "contig_no", "sequence")
    exact = cds.join(named.withColumnRenamed("contig", "seqid"), "seqid")
    rest = cds.join(named.select(F.col("contig").alias("seqid")), "seqid", "left_anti")
    wanted = rest.select("seqid").distinct()
    near = containing(wanted, "seqid", named, "contig").groupBy("seqid").agg(F.min_by("contig", "contig_no").alias("contig"))
    loose = rest.join(near, "seqid").join(named, "contig").select(*exact.columns)
    whole = rest.join(near, "seqid", "left_anti").select("protein_id").distinct()
    rows = exact.unionByName(loose).join(whole, "protein_id", "left_anti")
    piece = F.substr("sequence", F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    piece = F.when(F.col("strand") == "-", S.reverse_complement(piece)).otherwise(piece)
    piece = F.substr(piece, F.coalesce("phase", F.lit(0)) + 1)
    place = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    joined = rows.groupBy("protein_id").agg(F.sort_array(F.collect_list(F.struct(place.alias("p"), piece.alias("s")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: x["s"]), "")
    aa = F.replace(F.substring_index(S.translate(text), "*", 1), F.lit("X"), F.lit(""))
    return joined.select("protein_id", aa.alias("aa")).where(F.length("aa") >= min_aa)


def clean_proteins(proteins: DataFrame, min_aa: int = 30) -> DataFrame:
    return proteins.withColumn("aa", F.regexp_replace("aa", "[*X]", "")).where(F.length("aa") >= min_aa)


def protein_library(labels: DataFrame, proteins: DataFrame, frames: DataFrame) -> DataFrame:
    """Proteins where a label has any, with six-frame rows for the labels that have none."""
    own = proteins.join(labels.select("taxid"), "taxid", "left_semi").select("taxid", "id", "aa")
    rest = labels.select("taxid").join(own.select("taxid"), "taxid", "left_anti")
    return own.unionByName(frames.join(rest, "taxid", "left_semi").select("taxid", "id", "aa"))


def join_contigs(contigs: DataFrame, by: str = "taxid", spacer: int = SPACER) -> DataFrame:
    """One record for each genome, its contigs in order with unknown bases between them.

    A record is one text, so a genome must fit one (2 GB); ``genome_pieces``
    gives genomes of any size piece by piece.
    """
    ordered = F.sort_array(F.collect_list(F.struct("contig_no", "sequence")))
    return contigs.groupBy(by).agg(ordered.alias("c")).select(by, F.concat(F.lit("taxid:"), F.col(by)).alias("header"), F.array_join(F.transform("c", lambda x: x["sequence"]), "N" * spacer).alias("sequence"))


def number_records(records: DataFrame, file: str, order: str, taxid: Column) -> DataFrame:
    """Library headers seq<i>|kraken:taxid|<t>, numbered inside each file from 0."""
    numbered = running_sum(records.withColumn("__taxid", taxid), [file], [order], name="__i")
    header = F.concat(F.lit("seq"), F.col("__i").cast("string"), F.lit("|kraken:taxid|"), F.col("__taxid"))
    return numbered.withColumn("header", header).drop("__taxid", "__i")


def genome_pieces(contigs: DataFrame, by: str = "taxid", spacer: int = SPACER) -> DataFrame:
    """Each contig with its place (``start``, from 0) in the record of its genome; between two lie ``spacer`` unknown bases."""
    return running_sum(contigs, [by], ["contig_no"], F.length("sequence") + spacer, "start")
