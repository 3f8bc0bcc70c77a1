"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the
last return the columns of ``documents``. The stages work on every row that
their predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumkit.llm import packing, quality, queries, simhash, suffix_dedup, toxicity
from quorumkit.llm.common import bound_batches, materialize, read_table, scratch
from quorumkit.sinks.shared import delete_path, new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Word shingles of the near-duplicate stage; near duplicates differ in so few bits, or their shingles are that similar.
STAGE_SHINGLE_WORDS, STAGE_MAX_BITS, STAGE_SIMILARITY = 5, 4, 0.8
#: Bytes of a repeated passage, so short that a passage of over 50 words of about four letters is one.
STAGE_SPAN = 200


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage, with texts on their way to Python workers in small batches."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold. Labels of held-out rows are not learnt here either."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.with_toxicity(docs, model, "__toxicity").where(F.col("__toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    scored = quality.with_quality(docs, read_table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"), "__quality")
    return scored.where(F.col("__quality") >= quality.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id, of equal ids one row."""
    return simhash.keep_one_of_each(docs, STAGE_SHINGLE_WORDS, STAGE_MAX_BITS, STAGE_SIMILARITY).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages; n_chars follows the text.

    A character that is cut in part goes as a whole.
    """
    cut = suffix_dedup.remove_repeats(docs, STAGE_SPAN, as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("__text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("__text", text).select("doc_id", F.col("__text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in sequences."""
    return packing.pack_documents(docs, queries.VOCAB_PATH, queries.CAPACITY, queries.END_ID)


STAGES = [
    ("toxicity", _bounded(drop_toxic)),
    ("quality classifier", _bounded(drop_low_quality)),
    ("SimHash near-dedup", _bounded(drop_near_duplicates)),
    ("suffix-array dedup", _bounded(drop_repeated_passages)),
    ("best-fit packing", _bounded(pack)),
]

#: No stage but the last could be said in SQL, and that one not wholly; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again.

    Once a stage's result is stored, its own tables and its input, if an
    earlier stage wrote it, are deleted.
    """
    docs, before = read_table(spark, sf_dir, "documents").select(*COLUMNS), None
    *stages, (_, last) = STAGES
    for _, stage in stages:
        path = new_path(spark)
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), path)
        if before:
            delete_path(spark, before)
        before = path
    return last(spark, docs, sf_dir)
