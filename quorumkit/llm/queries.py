"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chroma, collocation, hilbert, licenses, merkle, packing, quality, simhash, suffix_dedup, toxicity, window_dedup
from .common import read_table

#: Parameters that the queries and the pipeline use.
VOCAB_PATH = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END_ID, N_SHARDS = 4096, 1, 16
REPEAT_SPAN = 400
SHINGLE_WORDS, MAX_BITS = 4, 4
NEAREST, QUERY_EVERY = 5, 50
WINDOW_WORDS = 20


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(read_table(spark, sf_dir, "documents"), VOCAB_PATH)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_digest(read_table(spark, sf_dir, "documents"), REPEAT_SPAN)


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(read_table(spark, sf_dir, "documents"), N_SHARDS)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(read_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), NEAREST, QUERY_EVERY)


def op8_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of every whole text are taken as 8-bit samples of a recording."""
    docs = read_table(spark, sf_dir, "documents")
    return chroma.search_recordings(docs.select(F.col("doc_id").alias("rec_id"), F.col("text").cast("binary").alias("media")), NEAREST, QUERY_EVERY)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), VOCAB_PATH, CAPACITY, END_ID)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op11_rabin_karp_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.windows_digest(read_table(spark, sf_dir, "documents"), WINDOW_WORDS)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(read_table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_suffix_dedup,
        op3_hilbert_shards,
        op4_license_scan,
        op5_quality_classifier,
        op6_toxicity,
        op7_multi_index_hashing,
        op8_chroma_fingerprints,
        op9_best_fit_packing,
        op10_simhash_near_dedup,
        op11_rabin_karp_windows,
        op12_merkle_manifest,
        op13_phrase_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": licenses.documents_sql(),
    "op11_rabin_karp_windows": window_dedup.windows_sql(WINDOW_WORDS),
    "op12_merkle_manifest": merkle.manifest_sql(),
    "op13_phrase_collocations": collocation.collocations_sql(),
}
