"""Nearest neighbours by multi-index hashing over learned binary codes.

Rotations that make the signs of the rotated coordinates good binary codes are
learnt on a bounded sample. Codes are split into substrings and each substring
is indexed: a code within Hamming radius r of a query has at least one
substring within floor(r / number of substrings) bits, so probing all values
that near finds every code within the radius. Those are ranked again with the
original vectors. Queries that found too few get a wider radius in a next round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

#: Rows that the rotations and the radius are learnt on, at most; the first in hash order.
SAMPLE_ROWS = 8_000
#: Rotations; each gives as many bits as the vectors have dimensions.
ROTATIONS = 4
SUBSTRING_BITS = 8
#: Share of a sample query's true neighbours that the first radius must reach.
REACH = 0.97
#: Queries in one block; a block of queries meets each block of codes in one task.
QUERY_BLOCK = 8192
CODE_BLOCK = 16_384
_POPCOUNT = np.bitwise_count(np.arange(1 << SUBSTRING_BITS, dtype=np.uint16)).astype(np.uint8)
#: For each radius the bit patterns that differ from zero by no more.
_NEAR = [np.flatnonzero(_POPCOUNT <= r) for r in range(SUBSTRING_BITS + 1)]


@dataclass
class BinaryCodes:
    """Centre, rotations and the radius for the first round."""

    mean: np.ndarray
    rotations: list[np.ndarray]
    radius: int

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """(rows, substrings) codes of unit vectors."""
        signs = np.concatenate([(unit - self.mean) @ r > 0 for r in self.rotations], axis=1)
        spare = -signs.shape[1] % SUBSTRING_BITS
        return np.packbits(np.pad(signs, ((0, 0), (0, spare))), axis=1)

    @property
    def bits(self) -> int:
        return sum(r.shape[1] for r in self.rotations)


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _POPCOUNT[a ^ b].sum(-1, dtype=np.int32)


def learn_codes(sample: np.ndarray, k: int, seed: int = 3, steps: int = 12) -> BinaryCodes:
    """Iterative quantisation: turn the axes so that coordinates are near their signs."""
    rng, d = np.random.default_rng(seed), sample.shape[1]
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    mean = unit.mean(0) if len(unit) else np.zeros(d)
    centred, rotations = unit - mean, []
    for _ in range(ROTATIONS):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(steps if len(unit) else 0):
            u, _, vt = np.linalg.svd(np.where(centred @ r > 0, 1.0, -1.0).T @ centred)
            r = (u @ vt).T
        rotations.append(r)
    codes = BinaryCodes(mean, rotations, 0)
    codes.radius = codes.bits
    if len(unit) > k:
        packed, asked = codes.encode(unit), rng.permutation(len(unit))[:400]
        far = []
        for q in asked:
            cos = unit @ unit[q]
            cos[q] = -2
            far.append(_hamming(packed[np.argpartition(-cos, k)[:k]], packed[q]))
        codes.radius = int(np.quantile(np.concatenate(far), REACH))
    return codes


class SubstringIndex:
    """For each substring, the rows of each of its values."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.ascontiguousarray(np.argsort(codes, axis=0, kind="stable").T)
        self.start = np.stack([np.searchsorted(codes[rows, s], np.arange((1 << SUBSTRING_BITS) + 1)) for s, rows in enumerate(self.order)])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` bits, all of them."""
        n, parts = self.codes.shape
        near = radius // parts
        # the first (radius mod parts) + 1 substrings may differ by near bits, one of the others must by less
        found = np.zeros(n, bool)
        for s in range(parts):
            allowed = near if s <= radius % parts else near - 1
            if allowed < 0:
                continue
            probes = _NEAR[min(allowed, SUBSTRING_BITS)] ^ int(code[s])
            first = self.start[s, probes]
            count = self.start[s, probes + 1] - first
            before = np.cumsum(count) - count
            found[self.order[s, np.repeat(first - before, count) + np.arange(count.sum())]] = True
            if found.all():
                break
        rows = np.flatnonzero(found)
        return rows[_hamming(self.codes[rows], code) <= radius]


def usable(vector: Column) -> Column:
    """True for vectors that are not null or zero and hold finite numbers only."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest by cosine.

    Queries are rows whose vec_id is divisible by ``every``; candidates are all
    rows but the query's own, also others with its vec_id. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without a vec_id or of
    another length than most of the sample. Ties go to the smaller vec_id;
    repeated rows are candidates of their own. Fewer candidates than k give all.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    # a power of two near the largest component: cosines stay as they are, and no square leaves the range of doubles
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform("v", F.abs)))))
    rows = rows.withColumn("scale", scale).select("vec_id", F.transform("v", lambda x: x / F.col("scale")).alias("v"))
    rows = materialize(rows.withColumn("m", F.monotonically_increasing_id()))
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(31)), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow().to_pandas()["v"]
    width = int(sample.map(len).mode().iloc[0]) if len(sample) else 1
    rows = rows.where(F.size("v") == width)
    codes = learn_codes(np.array([x for x in sample if len(x) == width], float).reshape(-1, width), k)
    total = rows.count()
    asked = materialize(rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", F.col("m").alias("q")))
    left, radius, done = asked, codes.radius, None
    while True:
        found = materialize(_search(left, rows, codes, radius, k, total))
        counts = found.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
        short = left.join(counts, "q", "left").where(F.coalesce("n", F.lit(0)) < k).select(left.columns)
        if radius >= codes.bits:
            short = short.limit(0)
        kept = found if radius >= codes.bits else found.join(counts.where(F.col("n") >= k), "q", "left_semi")
        done = kept if done is None else done.unionByName(kept)
        left = materialize(short)
        if not left.count():
            return done.select("query_id", "rank", "vec_id", "score")
        radius = min(codes.bits, radius + codes.bits // 8)


def _search(asked: DataFrame, rows: DataFrame, codes: BinaryCodes, radius: int, k: int, total: int) -> DataFrame:
    """One round: every block of queries against every block of rows."""
    n_query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    n_row_blocks = max(1, min(shuffle_partitions(rows.sparkSession), -(-total // 4096)), -(-total // CODE_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(n_query_blocks)).cast("int")).withColumn("rb", every(n_row_blocks))
    right = rows.withColumn("rb", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_row_blocks)).cast("int")).withColumn("qb", every(n_query_blocks))

    def matrix(table: pa.Table) -> np.ndarray:
        column = table.column("v").combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def match(queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[pd.DataFrame] = []
        if queries.num_rows and block.num_rows:
            x, y = matrix(queries), matrix(block)
            ids, rows_of, query_ids, numbers = block.column("vec_id").to_numpy(), block.column("m").to_numpy(), queries.column("query_id").to_numpy(), queries.column("q").to_numpy()
            nx, ny = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
            index, asked_codes = SubstringIndex(codes.encode(y / ny[:, None])), codes.encode(x / nx[:, None])
            for i in range(len(x)):
                at = index.within(asked_codes[i], radius)
                at = at[rows_of[at] != numbers[i]]
                score = np.einsum("ij,j->i", y[at], x[i]) / (ny[at] * nx[i])
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"q": numbers[i], "query_id": query_ids[i], "vec_id": ids[at][best], "score": score[best]}))
        schema = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        return pa.Table.from_pandas(pd.concat(out), schema, preserve_index=False) if out else schema.empty_table()

    tops = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(match, "q long, query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return tops.withColumn("rank", place).where(F.col("rank") <= k)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of true (query_id, vec_id) pairs that were found."""
    n = truth.count()
    return truth.join(found, ["query_id", "vec_id"], "left_semi").count() / n if n else 1.0

