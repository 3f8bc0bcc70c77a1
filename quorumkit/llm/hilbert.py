"""Sharding along a Hilbert curve over several metadata dimensions.

Rows that are near each other in all dimensions at once get neighbouring curve
positions, so a run of the curve has a narrow range in every dimension and a
reader that filters on any of them can skip most shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_or_empty

#: Bits for each dimension of the curve.
BITS = 8
#: Places that the rows of one text are dealt over.
SALTS = 64


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits``-bit coordinates.

    coords: (points, dimensions) unsigned. The transposed form of the index is
    computed with Gray-code steps, all points at once, and then interleaved.
    """
    x = coords.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):  # undo excess work from the top bit down
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where(x[n - 1] & (1 << b), t ^ ((1 << b) - 1), t)
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def quantise_number(value: Column, bits: int = BITS) -> Column:
    """Logarithmic cell of a number that is not negative; null and less than 1 go to cell 0.

    Eight cells for each doubling, so that the cells say the same at every size
    of input and need no pass over the data.
    """
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    cell = F.floor(F.log2(F.greatest(v, F.lit(1.0))) * 8)
    return F.least(cell, F.lit((1 << bits) - 1)).cast("int")


def quantise_label(value: Column, bits: int = BITS) -> Column:
    """Cell of a category: a hash of its text; null has the cell of the empty text."""
    return F.shiftrightunsigned(F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), 32 - bits).cast("int")


def with_curve(df: DataFrame, dims: list[Column], bits: int = BITS, name: str = "curve") -> DataFrame:
    """Add the curve index of quantised dimensions (ints under 2**bits)."""

    @F.pandas_udf("long")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    return df.withColumn(name, index(F.struct(*(d.alias(f"d{i}") for i, d in enumerate(dims)))))


def global_rank(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``__rank``, the row's place (from 0) in the order of all rows, and ``__total``.

    Rows are range-partitioned with sampled splitters and sorted in place; the
    sorted table is written once, so that the partition numbers stay true when
    a task runs again; then each partition's start is the sum of the counts
    before it, one number for each partition.
    """
    parts = max(1, shuffle_partitions(df.sparkSession))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    ranged = materialize(ranged.withColumns({"__part": F.shiftright(at, 33), "__pos": at.bitwiseAND((1 << 33) - 1)}))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"), F.sum("__n").over(everything).alias("__total"))
    joined = ranged.join(F.broadcast(starts), "__part")  # one row for each partition
    return joined.withColumn("__rank", F.col("__start") + F.col("__pos")).drop("__part", "__pos", "__start")


def hilbert_shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Cut all documents into ``n_shards`` runs of the curve with equal row counts.

    Dimensions are size in bytes, language and source. Law ``rows``: counts
    differ by one at most. Rows with equal texts (hash, CRC and length) are a
    group: all have the place on the curve of the group's least cells, and ties
    go by the text before the doc_id (null first), so groups stay whole but for
    those that a shard's border meets. A null text has no bytes (size 1, CRC 0)
    and is grouped with empty ones; repeated rows are rows of their own; an
    empty table gives no rows; other columns are not carried.
    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve index.
    """
    text = text_or_empty().cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("__hash"),
        F.struct(quantise_label(F.col("lang")).alias("lang"), quantise_label(F.col("source")).alias("source")).alias("__at"),
    )
    same = ["__hash", "text_crc32", "size"]
    rows = materialize(rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))))
    # a group of any size meets its least cells in SALTS places; the rows here have no texts
    parts = rows.groupBy(*same, "__salt").agg(F.min("__at").alias("__least"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*same)
    parts = parts.withColumns({"__least": F.min("__least").over(group), "__n": F.sum("__n").over(group)}).where("__n > 1").drop("__n")
    rows = rows.join(parts, [*same, "__salt"], "left").withColumn("__at", F.coalesce("__least", "__at")).drop("__salt")
    rows = with_curve(rows, [F.col("__at.lang"), F.col("__at.source"), quantise_number(F.col("size"))]).drop("__at", "__least")
    ranked = global_rank(rows, ["curve", *same, "doc_id"])
    # the first (total mod n) shards take one row more
    small, more = F.floor(F.col("__total") / n_shards), F.col("__total") % n_shards
    head = more * (small + 1)
    in_head = F.col("__rank") < head
    shard = F.when(in_head, F.floor(F.col("__rank") / (small + 1))).otherwise(more + F.floor((F.col("__rank") - head) / F.greatest(small, F.lit(1))))
    first = F.least(shard, more) * (small + 1) + F.greatest(shard - more, F.lit(0)) * small
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("__rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def shard_manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """For each shard its row count and the least and greatest value of each dimension."""
    bounds = [f(d).alias(f"{name}_{d}") for d in dims for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def prune_shards(manifest: DataFrame, dim: str, low, high) -> DataFrame:
    """Shards whose range of ``dim`` meets [low, high]; only these need to be read."""
    return manifest.where((F.col(f"max_{dim}") >= F.lit(low)) & (F.col(f"min_{dim}") <= F.lit(high))).select("shard")
