"""Label algebra: column expressions and column selectors for votes.

A label is a taxon id held as text; "0" means unclassified. A missing vote is
"0", a missing truth is the empty text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that stand for "no label".
NULL_LABELS = ("", "nan", "none", "na", "<na>")
COMBINER_NULLS = ("", "NA", "NaN", "nan", "None")
SPECIAL_LABELS = ("0", "other", "unclassified", "none", "na", "nan", "")
SKIP_LABELS = ("0", "nan", "None", "")
TRUE_PREFIXES = {"scer.fna": "4932", "ecoli.fna": "562", "hsap.fna": "9606", "phix.fna": "2886930"}
RANK_ALIASES = {"sp": "species", "g": "genus", "genera": "genus", "fam": "family"}
NO_RANK = ("", "none", "exact", "taxid", "raw", "false", "off")
RANK_COLUMNS = {"genus": "genera_taxid"}
#: What may follow ``taxid`` in a column name without being an annotator; callers may add names of their own tools.
META_TOOLS = ("true", "length", "sample")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, or null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def true_label(seq: Column, pattern: str | None = None, prefixes: Mapping[str, str] = TRUE_PREFIXES) -> Column:
    """Truth that a read id carries: caller's pattern, ``taxid:<n>``, a known prefix, else ''."""
    known = [F.when(F.lower(seq).rlike(rf"(^|\|){re.escape(p)}"), F.lit(label)) for p, label in prefixes.items()]
    own = []
    if pattern:
        own = [_found(seq, pattern, min(1, re.compile(pattern).groups))]
    return F.coalesce(*own, _found(seq, r"(?i)taxid:([0-9]+)"), *known, F.lit(""))


def canonical_label(value: Column) -> Column:
    """Null-like texts give '0', others their first run of digits (so '123.0' gives '123'), else the text."""
    text = F.trim(value.cast("string"))
    return F.when(text.isNull() | F.lower(text).isin(*NULL_LABELS), F.lit("0")).otherwise(F.coalesce(_found(text, r"(\d+)"), text))


def combiner_label(value: Column) -> Column:
    """The combiner's narrower rule: a few exact texts and null give '0'."""
    return F.when(value.isNull() | value.isin(*COMBINER_NULLS), F.lit("0")).otherwise(value)


def display_token(value: Column) -> Column:
    """Null-like gives '0', 'other' stays, '123.0' loses its '.0'; no digits are picked out."""
    text = F.trim(value.cast("string"))
    return F.when(text.isNull() | F.lower(text).isin(*NULL_LABELS), F.lit("0")).when(F.lower(text) == "other", F.lit("other")).when(text.rlike(r"^-*[0-9]+\.0$"), F.regexp_replace(text, r"\.0$", "")).otherwise(text)


def is_special(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)).isin(*SPECIAL_LABELS), F.lit(True))


def normalize_rank(rank: str | None) -> str | None:
    """Rank name in full; None means labels stay exact."""
    key = "" if rank is None else str(rank).strip().lower()
    return None if key in NO_RANK else RANK_ALIASES.get(key, key)


def rank_column(rank: str) -> str:
    rank = normalize_rank(rank) or "taxid"
    return RANK_COLUMNS.get(rank, f"{rank}_taxid")


def label_columns(columns: Sequence[str]) -> list[str]:
    """``true`` and every ``taxid*`` column in any case, without confidences."""
    return [c for c in columns if c == "true" or c.lower().startswith("taxid") and "confidence" not in c.lower()]


def annotator_columns(columns: Sequence[str]) -> list[str]:
    """``taxID_*`` and ``N_*`` columns without confidences."""
    return [c for c in columns if c.startswith(("taxID_", "N_")) and "confidence" not in c.lower()]


def regeneration_columns(columns: Sequence[str], meta: Sequence[str] = META_TOOLS) -> list[str]:
    """``taxID*`` columns that hold votes: no truth, confidence or run data."""
    return [c for c in columns if c.startswith("taxID") and not re.search(r"true|conf", c.lower()) and c.lower() not in meta]


def tool_name(column: str, meta: Sequence[str] = META_TOOLS) -> str | None:
    """Annotator in a column name such as taxID_kraken2_0; None for other columns."""
    name = column.lower()
    found = re.search(r"taxid[_./]*([a-z][a-z0-9]*)", name)
    if "confidence" in name or not found or found[1] in meta:
        return None
    return found[1]


def annotator_name(column: str) -> str:
    """Name without ``taxID_`` or ``N_`` and without a trailing run number."""
    return re.sub(r"_\d+$", "", re.sub(r"^(taxID|N)_", "", column))


def annotator_token(column: str) -> str:
    """The last but one token between underscores, as in taxID_kraken2_0."""
    tokens = column.split("_")
    return tokens[-2] if len(tokens) > 1 else column


def normalize_column_name(name: str) -> str:
    """Strip ``...<digits>`` and ``_<digits>`` at the end; ``taxid`` becomes ``taxID``."""
    return re.sub(r"taxid", "taxID", re.sub(r"_\d+$", "", re.sub(r"\.\.\.\d+$", "", name)))


def coalesce_same_names(df: DataFrame, rename=normalize_column_name) -> DataFrame:
    """Rename columns and merge those that then agree: the first that is not null wins ('0' is not null)."""
    groups: dict[str, list[int]] = {}
    for i, c in enumerate(df.columns):
        groups.setdefault(rename(c), []).append(i)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.coalesce(*(F.col(f"c{i}") for i in at)).alias(name) for name, at in groups.items()))


def as_number(value: Column) -> Column:
    """Text as a number; anything else is null."""
    return value.cast("string").try_cast("double")


def standardize_by_tool(df: DataFrame) -> DataFrame:
    """One numeric ``taxid_<tool>`` column for each tool; bad texts are null and skipped."""
    tools: dict[str, list[str]] = {}
    for c in df.columns:
        if tool := tool_name(c):
            tools.setdefault(tool, []).append(c)
    used = {c for cs in tools.values() for c in cs}
    merged = [F.coalesce(*(as_number(F.col(f"`{c}`")) for c in cs)).alias(f"taxid_{tool}") for tool, cs in tools.items()]
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in used), *merged)


def label_number(value: Column) -> Column:
    """First digits of a label as a number; none gives 0."""
    return F.coalesce(_found(value.cast("string"), r"(\d+)").try_cast("double"), F.lit(0.0))


def model_input(df: DataFrame) -> DataFrame:
    """Numbers only: seq and sample go, labels become their digits, length an int; rows without a numeric truth go."""
    kept = [c for c in df.columns if c not in ("seq", "sample")]
    out = []
    for c in kept:
        col = F.col(f"`{c}`")
        if c == "true":
            out.append(as_number(col).alias(c))
        elif c == "length":
            out.append(F.coalesce(as_number(col).cast("int"), F.lit(0)).alias(c))
        elif tool_name(c):
            out.append(label_number(col).alias(c))
        else:
            out.append(F.coalesce(as_number(col), F.lit(0.0)).alias(c))
    got = df.select(*out)
    return got.where(F.col("true").isNotNull()) if "true" in kept else got


def integer_part(value: Column) -> Column:
    return F.substring_index(value, ".", 1)


def is_skipped(value: Column) -> Column:
    return value.isNull() | value.isin(*SKIP_LABELS)


def all_unclassified(columns: Sequence[str]) -> Column:
    """True where every annotator says 0."""
    votes = [F.coalesce(as_number(F.col(f"`{c}`")), F.lit(0.0)) for c in columns]
    return F.forall(F.array(*votes), lambda v: v == 0) if votes else F.lit(True)


def fill_votes(df: DataFrame) -> DataFrame:
    """Missing votes and predictors become 0; truth never does."""
    return df.select(*(F.col(c) if c in ("true", "seq", "sample") else F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(t)).alias(c) for c, t in df.dtypes))


def display_label(value: Column, name: Column, width: int = 25) -> Column:
    """Name of a label cut to ``width`` characters; special labels as '0' or 'other'."""
    shown = F.when(F.lower(F.trim(value)) == "other", F.lit("other")).when(is_special(value), F.lit("0")).otherwise(F.coalesce(name, value))
    return F.when(F.length(shown) > width, F.concat(F.substring(shown, 1, width - 1), F.lit("…"))).otherwise(shown)


def safe_id(value: Column) -> Column:
    """Characters that FASTA ids should not hold become underscores."""
    return F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "_")


def record_id(taxid: Column) -> Column:
    return F.concat(F.lit("taxid:"), taxid)


def protein_id(accession: Column, taxid: Column) -> Column:
    return F.concat_ws("_", accession, taxid)


def library_id(number: Column, taxid: Column) -> Column:
    """Header of a reference library's record, numbered from 0."""
    return F.concat(F.lit("seq"), number.cast("string"), F.lit("|kraken:taxid|"), taxid)


def source_of_read(header: Column) -> Column:
    """``taxid:<n>`` in a read header, else the text before the first underscore."""
    return F.coalesce(_found(header, r"taxid:(\d+)"), F.substring_index(header, "_", 1))


def correctness(df: DataFrame, annotators: Sequence[str]) -> DataFrame:
    """One boolean per annotator: its vote equals the truth."""
    return df.withColumns({f"correct_{a}": F.coalesce(F.col(f"`{a}`") == F.col("true"), F.lit(False)) for a in annotators})


def rename_truth(df: DataFrame, names: DataFrame) -> DataFrame:
    """Replace ``true`` through a table (label, name); labels that it lacks become ''."""
    joined = df.join(names.select(F.col("label").alias("true"), F.col("name").alias("__name")), "true", "left")
    return joined.withColumn("true", F.coalesce("__name", F.lit(""))).select(*df.columns)


def export_columns(df: DataFrame) -> DataFrame:
    """Label columns, the first ``len*`` column as length, and the truth."""
    lengths = [c for c in df.columns if c.lower().startswith("len")][:1]
    votes = [c for c in label_columns(df.columns) if c != "true"]
    truth = ["true"] if "true" in df.columns else []
    return df.select(*(["seq"] if "seq" in df.columns else []), *votes, *(F.col(c).alias("length") for c in lengths), *truth)
