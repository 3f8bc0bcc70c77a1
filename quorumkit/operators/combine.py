"""Joining reports into vote tables, and changing between long and wide votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumkit.functions.labels import combiner_label, true_label


def first_of_duplicates(report: DataFrame) -> DataFrame:
    """Of equal read ids in one run of one report the first line stays."""
    return report.groupBy("sample", "tool", "run_idx", "seq").agg(F.min_by("taxid", "line_no").alias("taxid"), F.min_by("length", "line_no").alias("length"))


def combine_reports(report: DataFrame, annotators: Sequence[tuple[str, int]], fill: str | None = "0", pattern: str | None = None) -> DataFrame:
    """Wide vote table: sample, seq, taxID_<tool>_<run>..., length, true.

    One shuffle on (sample, seq) however many reports there are: each vote is
    the label of the first line of its run, the length the first that is not
    empty in annotator order. Missing votes get ``fill``; None leaves them null.
    """
    index = F.coalesce(*(F.when((F.col("tool") == t) & (F.col("run_idx") == r), F.lit(i)) for i, (t, r) in enumerate(annotators)))
    rows = report.withColumn("a", index).where("a IS NOT NULL")
    label = combiner_label(F.col("taxid")) if fill is not None else F.col("taxid")
    votes = [F.min_by(F.when(F.col("a") == i, label), F.when(F.col("a") == i, F.col("line_no"))).alias(f"taxID_{t}_{r}") for i, (t, r) in enumerate(annotators)]
    long_enough = F.when(F.coalesce(F.col("length"), F.lit("")) != "", F.struct("a", "line_no"))
    wide = rows.groupBy("sample", "seq").agg(*votes, F.coalesce(F.min_by("length", long_enough), F.lit("")).alias("length"))
    filled = wide if fill is None else wide.fillna(fill, subset=[f"taxID_{t}_{r}" for t, r in annotators])
    return filled.withColumn("true", true_label(F.col("seq"), pattern))


def votes_long(wide: DataFrame, annotators: Sequence[str], keys: Sequence[str] = ("sample", "seq")) -> DataFrame:
    """One row for each vote: keys, annotator, label."""
    return wide.unpivot(list(keys), list(annotators), "annotator", "label")


def votes_wide(votes: DataFrame, annotators: Sequence[str], keys: Sequence[str] = ("sample", "seq")) -> DataFrame:
    return votes.groupBy(*keys).pivot("annotator", list(annotators)).agg(F.first("label"))


def join_features(wide: DataFrame, features: DataFrame | None) -> DataFrame:
    """Left join of per-read features by read id; nothing happens without a key on both sides."""
    if features is None:
        return wide
    if "read_id" in features.columns and "seq" not in features.columns:
        features = features.withColumnRenamed("read_id", "seq")
    if "seq" not in features.columns or "seq" not in wide.columns:
        return wide
    own = [c for c in features.columns if c == "seq" or c not in wide.columns]
    return wide.join(features.select(*own), "seq", "left")


def distinct_labels(votes: DataFrame) -> DataFrame:
    """Every label that occurs in a long vote table."""
    return votes.select("label").where("label IS NOT NULL").distinct()


def missing_keys(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Wanted keys that a cached table lacks."""
    return wanted.select(key).distinct().join(known.select(key), key, "left_anti")


def counts_per_sample(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
