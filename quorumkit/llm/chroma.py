"""Chroma fingerprints of media columns, and alignment of recordings.

A binary column holds 8-bit mono samples. Short-time spectra are folded into
twelve pitch classes; filters over the integral image of the pitch-class frames
compare neighbouring regions, and their quantised values pack into one 32-bit
integer for each frame. Two recordings align at the frame offset that most
equal integers agree on, and the share of unequal bits over the overlap says
how well.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

RATE, FRAME, HOP = 8000, 256, 64
#: Frames that a filter may look at.
WIDTH = 16
#: Least common frames (all frames of a shorter print) and greatest share of unequal bits of an alignment.
MIN_OVERLAP, MAX_ERROR = 8, 0.35
#: Equal integers of a query and a block that are counted at once.
HIT_SLICE = 1 << 20
QUERY_BLOCK, RECORD_BLOCK = 32_768, 16_384


@lru_cache
def pitch_classes() -> np.ndarray:
    """Pitch class (0 to 11, A first) of each spectrum bin; -1 below 100 Hz."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    with np.errstate(divide="ignore"):
        pitch = np.round(12 * np.log2(np.maximum(hz, 1e-9) / 440.0)).astype(int)
    return np.where(hz >= 100, pitch % 12, -1)


def filters() -> list[tuple[int, int, int, int]]:
    """Sixteen (kind, first pitch class, height, width): four kinds of comparison at four places."""
    return [(kind, 3 * step, (12, 6, 9, 3)[step] if 3 * step + (12, 6, 9, 3)[step] <= 12 else 12 - 3 * step, (16, 12, 8, 4)[(kind + step) % 4]) for kind in range(4) for step in range(4)]


@lru_cache
def _fold() -> tuple[np.ndarray, np.ndarray]:
    """Window of a frame, and which spectrum bin falls into which pitch class."""
    return np.hanning(FRAME), (pitch_classes()[:, None] == np.arange(12)).astype(np.float64)


def chroma_frames(samples: np.ndarray) -> np.ndarray:
    """(frames, 12) pitch-class energies of unit length; silent frames are zero."""
    n = 1 + (len(samples) - FRAME) // HOP
    if n < 1:
        return np.zeros((0, 12))
    window, fold = _fold()
    signal = samples.astype(np.float64) - 128
    frames = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP] * window
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    energy = power @ fold
    length = np.sqrt((energy**2).sum(1, keepdims=True))
    return np.where(length > 1e-6, energy / np.maximum(length, 1e-6), 0.0)


def padded(samples: np.ndarray) -> np.ndarray:
    """Short recordings with silence after them: at least MIN_OVERLAP integers, or one for each HOP samples begun."""
    n = min(MIN_OVERLAP, -(-len(samples) // HOP))
    missing = FRAME + (WIDTH + n - 2) * HOP - len(samples)
    return np.concatenate([samples, np.full(missing, 128, np.uint8)]) if n and missing > 0 else samples


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each run of WIDTH frames of the padded recording; an empty one has none."""
    chroma = chroma_frames(padded(samples))
    n = len(chroma) - WIDTH + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((13, len(chroma) + 1))
    image[1:, 1:] = chroma.cumsum(0).cumsum(1).T

    def area(left: int, right: int, low: int, high: int) -> np.ndarray:
        return image[high, right : right + n] - image[high, left : left + n] - image[low, right : right + n] + image[low, left : left + n]

    sides = np.empty((2, 16, n))
    for i, (kind, low, height, width) in enumerate(filters()):
        mid, high, half, third = low + height // 2, low + height, width // 2, max(1, width // 3)
        if kind == 0:  # upper against lower pitch classes
            a, b = area(0, width, mid, high), area(0, width, low, mid)
        elif kind == 1:  # later against earlier
            a, b = area(half, width, low, high), area(0, half, low, high)
        elif kind == 2:  # diagonal quarters
            a, b = area(0, half, low, mid) + area(half, width, mid, high), area(half, width, low, mid) + area(0, half, mid, high)
        else:  # middle against both sides
            a = area(third, width - third, low, high)
            b = area(0, third, low, high) + area(width - third, width, low, high)
        sides[:, i] = a, b
    value = np.log((1 + sides[0]) / (1 + sides[1]))
    level = (value > -0.15).astype(np.uint32) + (value > 0) + (value > 0.15)
    level ^= level >> np.uint32(1)  # neighbouring levels differ in one bit
    return np.bitwise_or.reduce(level << np.arange(30, -1, -2, dtype=np.uint32)[:, None], axis=0)


def fingerprints(media: Column) -> Column:
    """array<int> of each recording; null and empty recordings give an empty array."""

    @F.arrow_udf("array<int>")
    def run(data: pa.Array) -> pa.Array:
        parts, ends = [np.zeros(0, np.uint32)], [0]
        for d in data:
            raw = d.as_buffer() if d.is_valid else None
            parts.append(fingerprint(np.frombuffer(raw, np.uint8)) if raw is not None and raw.size else parts[0])
            ends.append(ends[-1] + len(parts[-1]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).view(np.int32)))

    return run(media)


def alignments(query: np.ndarray, values: np.ndarray, records: np.ndarray, places: np.ndarray, begins: np.ndarray, prints: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Best long enough alignment of a query with each record of a block that shares an integer.

    values (sorted), records and places list the block's integers; begins and
    prints hold them record by record. Gives (record, offset of the query in it,
    votes, overlap, bit error rate).
    """
    low, high = np.searchsorted(values, query), np.searchsorted(values, query, side="right")
    n, span, half = high - low, 1 << 32, 1 << 31
    if not n.any():
        return []
    # hits in slices of bounded size; a slice takes at least one integer of the query
    cuts = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), HIT_SLICE), side="right"))
    keys, votes = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in zip(cuts, np.append(cuts[1:], len(query))):
        count = n[a:b]
        mine = np.repeat(np.arange(a, b), count)
        rows = np.repeat(low[a:b] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        found, times = np.unique(records[rows] * span + (places[rows] - mine + half), return_counts=True)
        keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
        votes = np.bincount(at, weights=np.concatenate([votes, times]), minlength=len(keys)).astype(np.int64)
    record, offset = keys // span, keys % span - half
    length = begins[record + 1] - begins[record]
    use = np.minimum(length, offset + len(query)) - np.maximum(0, offset) >= np.minimum(MIN_OVERLAP, np.minimum(length, len(query)))
    record, offset, votes = record[use], offset[use], votes[use]
    if not len(record):
        return []
    order = np.lexsort((offset, np.abs(offset), -votes, record))
    first = order[np.flatnonzero(np.concatenate([[True], record[order][1:] != record[order][:-1]]))]
    record, offset, votes = record[first], offset[first], votes[first]
    start = np.maximum(0, offset)
    overlap = np.minimum(begins[record + 1] - begins[record], offset + len(query)) - start
    ends = np.cumsum(overlap)
    step = np.arange(ends[-1]) - np.repeat(ends - overlap, overlap)
    theirs = prints[np.repeat(begins[record] + start, overlap) + step]
    error = np.add.reduceat(np.bitwise_count(theirs ^ query[np.repeat(start - offset, overlap) + step]).astype(np.int64), ends - overlap) / (32 * overlap)
    good = error <= MAX_ERROR
    return list(zip(*(x[good].tolist() for x in (record, offset, votes, overlap, error))))


def search_recordings(recordings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k best alignments of each query recording among all others.

    recordings: rec_id (long) and media (binary). Queries are rows whose rec_id
    is divisible by ``every``. Equal fingerprints form one class, named by its
    smallest rec_id (two classes may share a name where one id has two different
    recordings; both are candidates and queries); queries and candidates are classes, and a query's own class
    is its first match at offset 0 whenever the class has another member.
    Returns query_id, rank, match_id (a class), class_size, frame_offset, votes,
    overlap and bit_error, best first: fewest bit errors, longest overlap,
    smallest match_id. Recordings that are null or empty, and rows without an id,
    take no part.
    """
    prints = recordings.where(F.col("rec_id").isNotNull()).select("rec_id", fingerprints(F.col("media")).alias("print")).where(F.size("print") > 0)
    prints = prints.withColumns({"h1": F.xxhash64("print"), "h2": F.hash("print")})
    rows = materialize(prints)
    classes = rows.groupBy("h1", "h2").agg(F.min("rec_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.when(F.col("rec_id") % every == 0, F.col("rec_id"))).alias("query_id"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()))
    of_class = rows.join(classes.select("h1", "h2", F.col("class_id").alias("rec_id"), "class_size", "query_id", "cls"), ["h1", "h2", "rec_id"]).dropDuplicates(["h1", "h2"])
    of_class = materialize(of_class.select("cls", F.col("rec_id").alias("class_id"), "print", "class_size", "query_id"))
    total, n_queries = of_class.agg(F.count(F.lit(1)), F.count("query_id")).first()
    n_query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    n_record_blocks = max(1, min(shuffle_partitions(rows.sparkSession), -(-total // 8192)), -(-total // RECORD_BLOCK))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = of_class.where(F.col("query_id").isNotNull()).select("cls", "print", block("cls", n_query_blocks).alias("qb"), every_block(n_record_blocks).alias("rb"))
    right = of_class.select("cls", "class_id", "class_size", "print", block("cls", n_record_blocks).alias("rb"), every_block(n_query_blocks).alias("qb"))

    def match(queries: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and block.num_rows:
            lists = block.column("print").combine_chunks()
            flat = lists.flatten().to_numpy().view(np.uint32)
            begins = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            record = np.repeat(np.arange(len(lists)), np.diff(begins))
            place = np.arange(len(flat)) - begins[record]
            order = np.argsort(flat, kind="stable")
            values, records, places = flat[order], record[order], place[order]
            classes, ids, sizes = (block.column(c).to_numpy() for c in ("cls", "class_id", "class_size"))
            for q, own in zip(queries.column("cls").to_pylist(), queries.column("print")):
                got = alignments(own.values.to_numpy().view(np.uint32), values, records, places, begins, flat)
                got = [(q, int(ids[r]), int(sizes[r]), o, c, n, e) for r, o, c, n, e in got if classes[r] != q or sizes[r] > 1]
                found += sorted(got, key=lambda x: (x[6], -x[5], x[1]))[:k]
        names = ["cls", "match_id", "class_size", "frame_offset", "votes", "overlap", "bit_error"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        frame = pd.DataFrame(found, columns=names)
        return pa.Table.from_pandas(frame, pa.schema(list(zip(names, kinds))), preserve_index=False) if found else pa.schema(list(zip(names, kinds))).empty_table()

    tops = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(match, "cls long, match_id long, class_size long, frame_offset long, votes long, overlap long, bit_error double")
    place = F.row_number().over(Window.partitionBy("cls").orderBy("bit_error", F.desc("overlap"), "match_id"))
    tops = tops.withColumn("rank", place).where(F.col("rank") <= k)
    asked = rows.where(F.col("rec_id") % every == 0).join(classes.select("h1", "h2", "cls"), ["h1", "h2"]).select(F.col("rec_id").alias("query_id"), "cls")
    return asked.join(tops, "cls").select("query_id", "rank", "match_id", "class_size", "frame_offset", "votes", "overlap", "bit_error")
