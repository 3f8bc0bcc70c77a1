"""Best-fit packing of token sequences with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into
groups of bounded size; each group runs best-fit decreasing and compares its
bin count with a lower bound from dual-feasible functions. A group whose count
equals its bound is certified. Groups with a gap give up the pieces of their
emptiest bins; those are pooled, dealt anew into fewer groups and packed again,
until one group remains or nothing is left to exchange. Only lengths move
between tasks, never the tokens.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WordBpe, worker_bpe
from .common import bound_batches, materialize, release_memory
from .ragged import Ragged, slices

#: Bytes of text that are encoded at once; the arrays of a slice take about twenty times as much.
SLICE_BYTES = 1 << 20
#: Pieces in one group, which one task packs; about 3 MB of lengths.
GROUP_PIECES = 40_000
#: Bins that a group with a gap of g gives up: GIVE_UP * (g + 1), the emptiest first.
GIVE_UP = 16
#: Rounds of exchange. The pool shrinks by more than a hundred in each.
ROUNDS = 6
_PIECE = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
_PLAN = "k long, m long, length long, bin long, offset long, certified boolean, given boolean"


def _cut_pieces(ids: Ragged, capacity: int, end_id: int, with_ids: bool) -> pa.Array:
    """The pieces of each row of ids followed by ``end_id``, as lists of _PIECE."""
    total = ids.lengths + 1
    ends = np.cumsum(total)
    values = np.full(ends[-1] if len(ends) else 0, end_id, "<u4")
    own = np.ones(len(values), bool)
    own[ends - 1] = False
    values[own] = ids.values
    count = -(-total // capacity)
    piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(np.repeat(total, count) - start, capacity)
    at = np.repeat(ends - total, count) + start
    parts = [memoryview(values[a : a + n]).cast("B") for a, n in zip(at.tolist(), length.tolist())]
    columns = [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
    columns.append(pa.array([bytes(x) for x in parts], pa.binary()) if with_ids else pa.nulls(len(parts), pa.binary()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_PIECE)))


def _pieces_of(coder: WordBpe, texts: pa.Array, capacity: int, end_id: int, with_ids: bool) -> pa.Array:
    """The pieces of each text, slice by slice."""
    chunks = [_cut_pieces(coder.encode(part), capacity, end_id, with_ids) for part in slices(texts, SLICE_BYTES)]
    return pa.concat_arrays(chunks) if chunks else pa.array([], pa.list_(_PIECE))


def token_pieces(docs: DataFrame, vocab_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Cut each document's ids (plus ``end_id``) into pieces of at most ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32 and, on request, the ids.
    A null or empty text gives the single id ``end_id``. Repeated rows and null
    doc_ids are pieces of their own. Other columns are not carried along.
    """

    @F.arrow_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long,ids:binary>>")
    def cut(texts: pa.Array) -> pa.Array:
        out = _pieces_of(worker_bpe(vocab_path), texts, capacity, end_id, with_ids)
        release_memory()
        return out

    out = docs.select("doc_id", F.explode(cut(F.col("text").cast("string"))).alias("p"))
    return out.select("doc_id", *(f"p.{c}" for c in ("piece", "start", "length", "ids_crc32", "ids")[: 5 if with_ids else 4]))


def bin_lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by the best of a family of dual-feasible functions.

    For a threshold t, sizes over capacity - t count as whole bins, sizes under
    t as nothing, the others as their share; t = 0 is the plain sum.
    """
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    volume = np.concatenate([np.cumsum((counts * np.arange(capacity + 1))), [0]])
    number = np.concatenate([np.cumsum(counts), [0]])
    t = np.arange(0, capacity // 2 + 1)
    low = np.where(t > 0, volume[t - 1], 0)  # volume of sizes under t
    whole = number[capacity] - number[capacity - t]  # sizes over capacity - t
    middle = volume[capacity - t] - low
    return int(np.max(whole + -(-middle // capacity)))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin of each size, its offset there, number of bins); ties go to the earlier row."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms, made = 0, 0  # bit r of rooms: some bin has room r
    for row, size in zip(order.tolist(), sizes[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                rooms &= ~(1 << room)
        else:
            b, room, made = made, capacity, made + 1
        bins[row], offsets[row] = b, capacity - room
        left = room - size
        if left:
            open_at[left].append(b)
            rooms |= 1 << left
    return bins, offsets, made


def _pack_groups(pool: DataFrame, groups: int, capacity: int, last: bool) -> DataFrame:
    """One round: pack every group; mark what it gives up for the next round."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "m"], ascending=[False, True], ignore_index=True)
        sizes = pdf["length"].to_numpy()
        bins, offsets, made = best_fit_decreasing(sizes, capacity)
        gap = made - bin_lower_bound(sizes, capacity)
        given = np.zeros(len(sizes), bool)
        if gap and not last:
            filled = np.bincount(bins, weights=sizes, minlength=made)
            emptiest = np.lexsort((np.arange(made), filled))[: GIVE_UP * (gap + 1)]
            given = np.isin(bins, emptiest)
        return pd.DataFrame({"k": pdf["k"], "m": pdf["m"], "length": sizes, "bin": bins, "offset": offsets, "certified": gap == 0, "given": given})

    dealt = pool.select(F.pmod(F.xxhash64("m", F.lit(groups)), F.lit(groups)).alias("k"), "m", "length")
    return dealt.groupBy("k").applyInPandas(pack, _PLAN)


def best_fit_pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length`` of 1 to ``capacity``.

    All other columns stay (own columns named sequence_id or offset are
    replaced). Equal lengths and repeated rows are packed as separate pieces;
    no rows give no rows. Offsets in a sequence are gapless from 0.
    """
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    own = materialize(pieces.select(*keep).withColumn("__m", F.monotonically_increasing_id()))
    whole = F.col("length") >= capacity
    pool = own.where(~whole).select(F.col("__m").alias("m"), "length")
    left, done = pool.count(), []
    for step in range(ROUNDS):
        groups = max(1, -(-left // GROUP_PIECES))
        last = groups == 1 or step == ROUNDS - 1
        packed = materialize(_pack_groups(pool, groups, capacity, last))
        settled = packed.where(~F.col("given"))
        done.append(settled.select("m", ((F.lit(step) * (1 << 56)) + F.col("k") * (1 << 24) + F.col("bin")).alias("sequence_id"), "offset"))
        if last:
            break
        pool = packed.where("given").select("m", "length")
        left = pool.count()
        if not left:
            break
    plan = done[0]
    for more in done[1:]:
        plan = plan.unionByName(more)
    packed = own.where(~whole).join(plan.withColumnRenamed("m", "__m"), "__m")
    alone = own.where(whole).withColumns({"sequence_id": F.lit(1 << 62) + F.col("__m"), "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone).drop("__m")


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their sequence and place there."""
    bound_batches(docs.sparkSession)
    return best_fit_pack(token_pieces(docs, vocab_path, capacity, end_id), capacity)
