"""Removal of repeated passages with a distributed sparse suffix array.

A byte goes when a string of ``span`` bytes that covers it also starts
anywhere else. Every such string has a sampling point that its own bytes
decide (the least hash among its inner strings of ``CORE`` bytes), so only the
suffixes at sampling points are sorted, not one for each byte. A suffix is
compared token by token, where a token is the 64-bit fingerprint of a stretch
of bytes; any order in which equal stretches are neighbours finds the same
repeats.

Each of three levels range-partitions its suffixes by their leading tokens
with sampled splitters, sorts every bucket by multikey quicksort and compares
neighbours, also across the boundaries of buckets:

1. around each sampling point, the ``CORE`` bytes that all strings with that
   point share, and the wide stretch that holds all of those strings. An equal
   wide stretch means that all of them repeat; a core that occurs with several
   wide stretches goes on;
2. cells of ``CELL`` neighbouring strings, likewise, with the few bytes on either side;
3. single strings of ``span`` bytes.

The order includes document and position, so a passage that a third of all
documents share is spread over as many buckets as it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release_memory, shuffle_partitions, text_or_empty

#: Strings that share a sampling point are at most so many; fewer if spans are short.
SPREAD = 128
#: Strings in a cell of the second level.
CELL = 16
#: Bytes that a task fingerprints at once; longer texts are taken in overlapping stretches of this length.
STRETCH = 1 << 18
_SMALL = 2048
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))  # odd, so they have inverses modulo 2**64
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_OUT = "kind int, part int, t1 long, t2 long, k1 long, k2 int, pos int, len int"
_MARK, _NEXT, _FIRST, _LAST = range(4)


def spread_of(span: int) -> int:
    """Strings of ``span`` bytes that share a sampling point at most: a multiple of CELL, half a span at most."""
    return min(SPREAD, span // 2 // CELL * CELL)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Prints:
    """Fingerprints of any stretch of one byte buffer, from prefix sums modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        if which not in self._powers or len(self._powers[which][0]) < n + 1:
            base, size = _BASES[which], max(n + 1, 1 << 16)
            inverse = _U(pow(int(base), -1, 1 << 64))
            self._powers[which] = tuple(np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, b, np.uint64)])) for b in (base, inverse))
        self.power, self.inverse = self._powers[which]
        self.prefix = np.concatenate([[_U(0)], np.cumsum(_BYTES[which][data] * self.power[:n])])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]


def sampling_points(prints: np.ndarray, spread: int) -> np.ndarray:
    """For each window of ``spread`` fingerprints the place of its least one, the last on ties."""
    n = len(prints)
    mask = _U((1 << 24) - 1)
    key = (_mix(prints) & ~mask) | (mask - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // spread) * spread, ~_U(0))
    padded[:n] = key
    blocks = padded.reshape(-1, spread)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - spread + 1], ahead[spread - 1 : n])
    return (mask - (least & mask)).astype(np.int64)


def multikey_quicksort(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their token sequences.

    Rows are split three ways about a pivot token; only those that equal it go
    on to the next token. Small parts are ordered directly.
    """
    done, stack = [], [(np.arange(len(tokens[0])), 0)]
    while stack:
        rows, depth = stack.pop()
        if depth == len(tokens):
            done.append(rows)
        elif len(rows) <= _SMALL:
            done.append(rows[np.lexsort([t[rows] for t in tokens[: depth - 1 if depth else None : -1]])])
        else:
            token = tokens[depth][rows]
            sample = np.sort(token[:: len(token) // 101])
            pivot = sample[len(sample) // 2]
            stack += [(rows[token > pivot], depth), (rows[token == pivot], depth + 1), (rows[token < pivot], depth)]
    return np.concatenate(done) if done else np.arange(0)


def _stretches(texts: list[bytes], span: int) -> Iterator[tuple[list[tuple[int, int, int, int]], bytes]]:
    """Batches of (text number, offset in its text, first and last window start) and their bytes.

    A long text comes in stretches that overlap enough for every wide stretch.
    """
    spread = spread_of(span)
    items, data, size = [], [], 0
    for i, text in enumerate(texts):
        windows = len(text) - span + 1
        for first in range(0, max(0, windows), STRETCH):
            last = min(windows, first + STRETCH)
            left = max(0, first - spread)
            part = text[left : last + span + spread]
            items.append((i, left, first - left, last - left))
            data.append(part)
            size += len(part)
            if size >= STRETCH:
                yield list(zip(items, map(len, data))), b"".join(data)
                items, data, size = [], [], 0
    if items:
        yield list(zip(items, map(len, data))), b"".join(data)


def _suffixes(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """First level: the sampled suffixes of each text."""
    spread = spread_of(span)
    core, wide = span - spread + 1, span + spread - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            texts = [t.as_py() for t in batch.column("data")]
            last_of: dict[int, int] = {}
            for items, joined in _stretches(texts, span):
                data = np.frombuffer(joined, np.uint8)
                lengths = np.array([n for _, n in items])
                begins = np.cumsum(lengths) - lengths
                meta = np.array([x for x, _ in items])
                prints = Prints(data)
                at = np.arange(len(data) - core + 1)
                point = sampling_points(prints.of(at, core), spread)
                # window starts of each item, then their points, once each
                count = meta[:, 3] - meta[:, 2]
                item = np.repeat(np.arange(len(items)), count)
                window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begins + meta[:, 2], count)
                chosen = point[window]
                fresh = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (item[1:] != item[:-1])]) if len(chosen) else np.zeros(0, bool)
                chosen, item = chosen[fresh], item[fresh]
                text = meta[item, 0]
                pos = chosen - begins[item] + meta[item, 1]
                if any(m in last_of for m in meta[:, 0].tolist()):  # a later stretch of a long text may find the last point again
                    seen = np.array([last_of.get(t, -1) for t in text.tolist()])
                    chosen, item, text, pos = (x[pos > seen] for x in (chosen, item, text, pos))
                for t, p in zip(text.tolist(), pos.tolist()):
                    if len(texts[t]) > STRETCH:
                        last_of[t] = p
                low = chosen - (spread - 1)
                fits = (low >= begins[item]) & (low + wide <= begins[item] + lengths[item])
                alone = _mix(k1[text].view(np.uint64) ^ _mix(k2[text].astype(np.uint64) * _BASES[1] + pos.astype(np.uint64)))
                hull = np.where(fits, _mix(prints.of(np.where(fits, low, 0), np.where(fits, wide, 0))), alone)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mix(prints.of(chosen, core)).view(np.int64)), pa.array(hull.view(np.int64)), pa.array(k1[text]), pa.array(k2[text]), pa.array(pos.astype(np.int32))],
                    names=["t1", "t2", "k1", "k2", "pos"],
                )
            release_memory()

    return run


def _cells(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Second level: cells of the strings around the points that went on."""
    core, side, spread = span - CELL + 1, CELL - 1, spread_of(span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("data"), batch.column("points"))
            out: list[list[np.ndarray]] = []
            for k1, k2, data, points in rows:
                text = np.frombuffer(data.as_py(), np.uint8)
                starts = (np.array(points.as_py())[:, None] - np.arange(0, spread, CELL)).ravel()
                starts = np.unique(starts[(starts >= 0) & (starts + core <= len(text))])
                left, right = np.minimum(side, starts), np.minimum(side, len(text) - starts - core)
                use = left + right >= side
                starts, left, right = starts[use], left[use], right[use]
                if not len(starts):
                    continue
                begin = int(starts[0])  # only the stretch that the cells cover is fingerprinted
                part = text[begin : int(starts[-1]) + core]
                around = np.zeros((len(starts), 2 * side + 2), np.uint8)
                around[:, 0], around[:, 1] = left, right
                for i in range(side):
                    has = left > i
                    around[has, 2 + i] = text[starts[has] - 1 - i]
                    has = right > i
                    around[has, 2 + side + i] = text[starts[has] + core + i]
                words = around.view(">u8").astype(np.uint64)
                h = [Prints(part, w).of(starts - begin, core) for w in (0, 1)]
                out.append([*h, *words.T, np.full(len(starts), k1), np.full(len(starts), k2, np.int32), starts.astype(np.int32)])
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols[:6]] + [pa.array(c) for c in cols[6:]], names=[*(f"t{i}" for i in range(1, 7)), "k1", "k2", "pos"])
            release_memory()

    return run


def _strings(span: int, h1: np.ndarray, h2: np.ndarray, words: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The single strings of each cell, from its core's prints and the bytes around it."""
    core, side = span - CELL + 1, CELL - 1
    around = words.astype(">u8").view(np.uint8).reshape(len(words), -1)
    left, right = around[:, 0].astype(int), around[:, 1].astype(int)
    for lead in range(CELL):
        use = np.flatnonzero((left >= lead) & (right >= side - lead))
        if not len(use):
            continue
        got = []
        for which, h in ((0, h1), (1, h2)):
            base, table = int(_BASES[which]), _BYTES[which]
            total = h[use] * _U(pow(base, lead, 1 << 64))
            for i in range(lead):  # byte i to the left of the core stands at lead - 1 - i
                total = total + table[around[use, 2 + i]] * _U(pow(base, lead - 1 - i, 1 << 64))
            for i in range(side - lead):
                total = total + table[around[use, 2 + side + i]] * _U(pow(base, lead + core + i, 1 << 64))
            got.append(total)
        yield use, pos[use] - lead, got[0], got[1]


def _compare(level: int, span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sort one bucket and compare neighbours.

    Gives marks (stretches that repeat), what the next level needs, and the
    first and last suffix, which are compared with other buckets later. A core
    group at either end of the bucket may go on elsewhere and always passes to
    the next level.
    """
    spread = spread_of(span)
    n_tokens, n_core = {1: (2, 1), 2: (6, 2), 3: (2, 2)}[level]

    def batch(kind, part, t1, t2, k1, k2, pos, length) -> pa.RecordBatch:
        n = len(pos)
        full = lambda v, t: np.full(n, v, t) if np.isscalar(v) else v.astype(t)
        cols = [full(kind, np.int32), full(part, np.int32), full(t1, np.int64), full(t2, np.int64), k1, k2, pos.astype(np.int32), full(length, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "part", "t1", "t2", "k1", "k2", "pos", "len"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        del got
        tokens = [table.column(f"t{i + 1}").to_numpy() for i in range(n_tokens)]  # signed, as the buckets are ranged
        k1, k2, pos = (table.column(c).to_numpy() for c in ("k1", "k2", "pos"))
        order = multikey_quicksort(tokens)
        tokens, k1, k2, pos = [t[order].view(np.uint64) for t in tokens], k1[order], k2[order], pos[order]
        n, part = len(order), TaskContext.get().partitionId()
        same_core = np.logical_and.reduce([t[1:] == t[:-1] for t in tokens[:n_core]])
        same = np.logical_and.reduce([same_core, *(t[1:] == t[:-1] for t in tokens[n_core:])])
        edge = np.zeros(n, bool)
        edge[[0, -1]] = True
        twin = np.zeros(n, bool)
        twin[1:] |= same
        twin[:-1] |= same
        if level == 1:
            start, length = pos - (spread - 1), np.full(n, span + spread - 1)
        elif level == 2:
            left, right = (tokens[2] >> _U(56)).astype(np.int32), ((tokens[2] >> _U(48)) & _U(255)).astype(np.int32)
            start, length = pos - left, left + right + span - CELL + 1
        else:
            start, length = pos, np.full(n, span)
        yield batch(_MARK, part, 0, 0, k1[twin], k2[twin], start[twin], length[twin])
        ends = np.flatnonzero(edge)
        pair = tokens if n_tokens == 2 else [np.zeros(n, np.uint64)] * 2
        if n_tokens > 2:
            for t in tokens:
                pair = [_mix(p * b + t) for p, b in zip(pair, _BASES)]
        for kind, i in ((_FIRST, ends[:1]), (_LAST, ends[-1:])):
            if kind == _FIRST or n > 1:
                yield batch(kind, part, pair[0][i].view(np.int64), pair[1][i].view(np.int64), k1[i], k2[i], start[i], length[i])
        if level == 3:
            return
        group = np.concatenate([[0], np.cumsum(~same_core)])
        varied = np.zeros(group[-1] + 1, bool)
        varied[group[1:][same_core & ~same]] = True
        varied[[0, -1]] = True
        pick = varied[group] & np.concatenate([[True], ~same])  # the first of each run of equals
        if level == 1:
            yield batch(_NEXT, part, 0, 0, k1[pick], k2[pick], pos[pick], 0)
        else:
            rows = np.flatnonzero(pick)
            for at in range(0, len(rows), 1 << 16):
                i = rows[at : at + (1 << 16)]
                for use, where, h1, h2 in _strings(span, tokens[0][i], tokens[1][i], np.stack([t[i] for t in tokens[2:]], 1), pos[i]):
                    yield batch(_NEXT, part, _mix(h1).view(np.int64), _mix(h2).view(np.int64), k1[i][use], k2[i][use], where, 0)
        release_memory()

    return run


def _level(rows: DataFrame, level: int, span: int) -> tuple[DataFrame, DataFrame]:
    """(marks, rows for the next level)."""
    tokens = [c for c in rows.columns if c[0] == "t"]
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *tokens, "k1", "pos")
    out = materialize(ranged.mapInArrow(_compare(level, span), _OUT))
    by = Window.orderBy("part", "kind")  # two rows for each bucket
    ends = out.where(F.col("kind") >= _FIRST)
    pair = F.struct("t1", "t2")
    met = ends.withColumn("met", (pair == F.lag(pair).over(by)) | (pair == F.lead(pair).over(by))).where("met")
    columns = ("k1", "k2", "pos", "len")
    return out.where(F.col("kind") == _MARK).select(*columns).unionByName(met.select(*columns)), out.where(F.col("kind") == _NEXT)


def _keyed(docs: DataFrame, text: Column) -> DataFrame:
    """Two hashes of (doc_id, text) name a row; rows that agree in both are repeats of each other."""
    return docs.withColumns({"k1": F.xxhash64("doc_id", text), "k2": F.hash(text, "doc_id"), "data": text.cast("binary")})


def repeated_marks(docs: DataFrame, span: int = 400) -> DataFrame:
    """(k1, k2, marks): for each document, stretches (pos, len) whose every byte is repeated."""
    if span < 2 * CELL:
        raise ValueError(f"span must be at least {2 * CELL}")
    keyed = _keyed(docs.select("doc_id", "text"), text_or_empty()).select("k1", "k2", "data").where(F.octet_length("data") >= span)
    rows = keyed.mapInArrow(_suffixes(span), "t1 long, t2 long, k1 long, k2 int, pos int")
    marks1, points = _level(rows, 1, span)
    points = points.groupBy("k1", "k2").agg(F.collect_set("pos").alias("points"))
    cells = keyed.join(points, ["k1", "k2"]).mapInArrow(_cells(span), ", ".join(f"t{i} long" for i in range(1, 7)) + ", k1 long, k2 int, pos int")
    marks2, strings = _level(cells, 2, span)
    marks3, _ = _level(strings.select("t1", "t2", "k1", "k2", "pos").distinct(), 3, span)
    marks = marks1.unionByName(marks2).unionByName(marks3)
    return marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "len")).alias("marks"))


def remove_repeats(docs: DataFrame, span: int = 400, as_text: bool = False) -> DataFrame:
    """Add n_bytes, n_removed, removed_spans and kept to each document.

    kept is binary, or with ``as_text`` text without the characters that were cut in part.

    A null text counts as empty; texts under ``span`` bytes lose nothing. Rows
    that repeat another row wholly (same doc_id and text) count as copies of
    each other and lose all bytes if long enough. No rows give no rows. Other
    columns stay; columns with the names of the added ones are replaced.
    """
    work = ("n_bytes", "n_removed", "removed_spans", "kept")
    base = docs.drop(*work)
    text = text_or_empty()
    rows = base.select(F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("row"), "doc_id", text.alias("text"))
    keyed = _keyed(rows, F.col("text")).select("row", "k1", "k2")  # a row moves with its text once; its bytes come from that afterwards
    marks = repeated_marks(base, span)
    again = _keyed(base.select("doc_id", "text"), text).where(F.octet_length("data") >= span).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("again")).where("again > 1")
    extra = marks.join(again, ["k1", "k2"], "full_outer")

    @F.arrow_udf(f"struct<spans:array<struct<start:int,end:int>>,kept:{'string' if as_text else 'binary'},size:long>")
    def cut(data: pa.Array, marks: pa.Array, again: pa.Array) -> pa.Array:
        spans, kept, sizes = [], [], []
        for d, m, a in zip(data, marks, again):
            raw = d.as_py()
            found = [(0, len(raw))] if a.as_py() else sorted((x["pos"], x["pos"] + x["len"]) for x in m.as_py() or ())
            merged: list[list[int]] = []
            for start, end in found:
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            left, at = [], 0
            for start, end in merged:
                left.append(raw[at:start])
                at = end
            spans.append([{"start": s, "end": e} for s, e in merged])
            rest = b"".join([*left, raw[at:]])
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            sizes.append(len(rest))
        release_memory()
        return pa.StructArray.from_arrays([pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(sizes, pa.int64())], names=["spans", "kept", "size"])

    whole = F.coalesce(F.col("row")["text"], F.lit("")).cast("binary")
    joined = keyed.join(extra, ["k1", "k2"], "left").withColumn("data", whole).withColumn("cut", cut("data", "marks", "again"))
    n = F.octet_length("data").cast("long")
    return joined.select("row.*", n.alias("n_bytes"), (n - F.col("cut.size")).alias("n_removed"), F.col("cut.spans").alias("removed_spans"), F.col("cut.kept").alias("kept"))


def repeats_digest(docs: DataFrame, span: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the SHA-256 of the bytes that stay, their number, and whether any was removed."""
    out = remove_repeats(docs.select("doc_id", "text"), span)
    return out.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )
