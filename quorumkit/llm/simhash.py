"""Near-duplicate documents by SimHash and a Gray-order hierarchical index.

Fingerprints that differ in at most ``radius`` bits agree on some choice of
blocks of the 64 bits, so each distinct fingerprint is sent once to the bucket
of each such choice. A task sorts its buckets by Gray rank, in which neighbours
differ in few bits, and stacks upper nodes over runs of neighbours. A node
holds the bit pattern that its members share; differences between two patterns
add up on the way down and a pair of nodes is dropped with all its members as
soon as they exceed the radius. Pairs of nodes that are wholly in one component
already need no further look. Only a spanning set of links leaves a task, never
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumkit.sinks.shared import new_path

from .common import TEXT_CODEC, materialize, release_memory, scratch, shuffle_partitions
from .components import connected_components
from .lookup import rows_in
from .resemblance import Minima, resemblance_edges, shingle_hashes, words_of

#: Children of a node of the index.
FANOUT = 8
#: A bucket with more fingerprints is cut into chunks, and each pair of chunks is a bucket of its own.
BUCKET_ROWS = 500_000
#: Mean fingerprints in a bucket up to which coarser blocks (fewer copies) are used.
MEAN_BUCKET = 32
#: Rows that a task gathers before it links the buckets that are complete.
STREAM_ROWS = 1_000_000
_PAIRS = 20_000


def _majority(words: list[bytes], shingle_words: int, least: Minima | None = None) -> int:
    """SimHash of the shingles of some words; ``least`` sees the same hashes."""
    n, total = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(words, shingle_words):
        n += len(h)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        if least is not None:
            least.feed(h)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def text_fingerprint(text: str | None, shingle_words: int) -> int:
    """64-bit SimHash of one text: majority bits over the XXH64 of its word shingles; 0 without words."""
    return _majority(words_of(text), shingle_words)


def simhash(text: Column | str, shingle_words: int = 4) -> Column:
    """Fingerprint of each text as a long (the 64 bits, signed); null and empty texts give 0."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        out = np.fromiter((text_fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        release_memory()
        return pa.array(out.view(np.int64))

    return fingerprint(text)


def sketch(text: Column, shingle_words: int) -> Column:
    """In one pass the fingerprint, 128 bits that equal sequences of words share, and the bands of each text."""

    @F.arrow_udf("code long, h1 long, h2 long, bands array<long>")
    def run(texts: pa.Array) -> pa.Array:
        codes, same, bands = np.zeros(len(texts), np.uint64), np.zeros((len(texts), 2), np.uint64), []
        for i, t in enumerate(texts):
            words, least = words_of(t.as_py()), Minima()
            codes[i] = _majority(words, shingle_words, least)
            same[i] = np.frombuffer(xxhash.xxh128_digest(b" ".join(words)), np.uint64)
            bands.append(least.bands() if words else [])
        release_memory()
        columns = [pa.array(codes.view(np.int64)), *(pa.array(np.ascontiguousarray(h).view(np.int64)) for h in same.T), pa.array(bands, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["code", "h1", "h2", "bands"])

    return run(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the sequence of Gray codes."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of each pair (a, b); root[i] is the least row of i's component."""
    while True:
        a, b = root[a], root[b]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (further := root[root]).tobytes() != root.tobytes():
            root[:] = further


def link_buckets(bucket: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and, for each, a linked representative, over all buckets at once.

    Returns two equally long arrays: codes that are not their component's
    first, and that first code. Components are those of links inside a bucket.
    """
    order = np.lexsort((gray_rank(codes), bucket))
    bucket, codes = bucket[order], codes[order]
    n = len(codes)
    if n < 2:
        return codes[:0], codes[:0]
    new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    first = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    place = np.arange(n) - first[number]
    # levels[l]: first row, shared-bit mask, pattern, free bits' AND and OR, first child and number of children of each node
    levels = [(np.arange(n), codes, codes, None, None)]
    width = 1
    while np.diff(np.concatenate([first, [n]])).max() > width:
        width *= FANOUT
        fresh = np.concatenate([[True], (number[1:] != number[:-1]) | (place[1:] // width != place[:-1] // width)])
        start, below = np.flatnonzero(fresh), levels[-1][0]
        child = np.searchsorted(below, start)
        levels.append((start, np.bitwise_and.reduceat(codes, start), np.bitwise_or.reduceat(codes, start), child, np.diff(np.concatenate([child, [len(below)]]))))
    root = np.arange(n)

    def settled(level: int) -> np.ndarray:
        """For each node the component that all its rows are in, or -1."""
        start = levels[level][0]
        low, high = np.minimum.reduceat(root, start), np.maximum.reduceat(root, start)
        return np.where(low == high, low, -1)

    for level in range(1, len(levels)):
        _, _, _, child, count = levels[level]
        stack = []
        for p, q in combinations(range(FANOUT), 2):
            has = count > q
            if has.any():
                stack.append((level - 1, child[has] + p, child[has] + q))
        one = [settled(x) for x in range(level)]
        while stack:
            at, a, b = stack.pop()
            if len(a) > _PAIRS:
                stack.append((at, a[_PAIRS:], b[_PAIRS:]))
                a, b = a[:_PAIRS], b[:_PAIRS]
            start, low, high, down, kids = levels[at]
            done = (one[at][a] >= 0) & (root[start[a]] == root[start[b]]) & (one[at][b] >= 0)
            a, b = a[~done], b[~done]
            shared = ~(low[a] ^ high[a]) & ~(low[b] ^ high[b])
            near = np.bitwise_count((low[a] ^ low[b]) & shared) <= radius
            a, b = a[near], b[near]
            if not len(a):
                continue
            if at == 0:
                _unite(root, a, b)
                continue
            free = (high[a] | high[b]) & ~(low[a] & low[b])
            every = np.bitwise_count(free) <= radius
            _unite(root, start[a[every]], start[b[every]])
            a, b = a[~every], b[~every]
            for p in range(FANOUT):
                for q in range(FANOUT):
                    has = (kids[a] > p) & (kids[b] > q)
                    if has.any():
                        stack.append((at - 1, down[a[has]] + p, down[b[has]] + q))
    moved = root != np.arange(n)
    return codes[moved], codes[root[moved]]


def block_masks(n_codes: int, radius: int) -> list[int]:
    """Masks of which any two codes within ``radius`` bits agree on at least one.

    With radius + c blocks two such codes agree on some c of them. More blocks
    make smaller buckets and more copies; the result is the same for any.
    """
    for c in range(1, 9):
        blocks = radius + c
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in combinations(bits, c)]
        if n_codes / 2 ** min(m.bit_count() for m in masks) <= MEAN_BUCKET:
            break
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_code_edges(codes: DataFrame, radius: int) -> DataFrame:
    """Spanning links (a, b) of distinct 64-bit codes (column ``code``) within ``radius`` bits."""
    n = codes.count()
    masks = block_masks(n, radius)
    keys = [F.xxhash64(F.lit(t), F.col("code").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(masks)]
    sent = codes.select("code", F.explode(F.array(*keys)).alias("bucket"))
    if n > BUCKET_ROWS:  # otherwise no bucket can be that large
        hot = sent.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
        hot = hot.select("bucket", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("chunks"))
        own = F.pmod(F.xxhash64(F.lit(-1), "code"), F.col("chunks")).cast("int")
        pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: F.xxhash64("bucket", F.least(i, own), F.greatest(i, own)))
        sent = sent.join(hot, "bucket", "left").select("code", F.explode(F.when(F.col("chunks") > 1, pair).otherwise(F.array("bucket"))).alias("bucket"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def run(bucket: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
            a, b = link_buckets(bucket, code.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append((batch.column("bucket").to_numpy(zero_copy_only=False), batch.column("code").to_numpy(zero_copy_only=False)))
            size += batch.num_rows
            if size >= STREAM_ROWS:
                bucket, code = map(np.concatenate, zip(*held))
                cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if cut:
                    yield run(bucket[:cut], code[:cut])
                held, size = [(bucket[cut:], code[cut:])], len(bucket) - cut
        if held:
            yield run(*map(np.concatenate, zip(*held)))

    dealt = sent.repartition(shuffle_partitions(codes.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "code").mapInArrow(link, "a long, b long").distinct()


def code_components(codes: DataFrame, radius: int) -> DataFrame:
    """(code, root) for distinct codes that have a neighbour within ``radius`` bits."""
    found = connected_components(near_code_edges(codes, radius))
    return found.select(F.col("node").alias("code"), "root")


def keep_one_of_each(docs: DataFrame, shingle_words: int = 5, radius: int = 4, similarity: float = 0.8) -> DataFrame:
    """One row of each near-duplicate group, with all its columns.

    Groups are components over two kinds of links: fingerprints within
    ``radius`` bits, and sets of shingles with that Jaccard similarity or more,
    which so few bits would not reach. The row with the smallest doc_id stays
    (ids that are null come last); of rows with the same id, the first as
    written. Null and empty texts form one group. Equal sequences of words are
    one class before anything is compared; no text is shuffled, rows are looked
    up by their numbers where they were written.
    """
    rows = materialize(docs.withColumns({"__sketch": sketch(F.col("text").cast("string"), shingle_words), "__row": F.monotonically_increasing_id()}), compression=TEXT_CODEC)
    numbers = new_path(docs.sparkSession)
    with scratch(docs.sparkSession):  # the result reads the rows and the numbers alone
        prints = rows.select("__sketch.code", "__sketch.h1", "__sketch.h2", F.col("__row").alias("row"), "doc_id")
        best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("best")
        classes = materialize(prints.groupBy("h1", "h2").agg(F.min("row").alias("cls"), F.min("code").alias("code"), best))
        bands = rows_in(rows.select(F.col("__row").alias("cls"), "__sketch.code", "__sketch.bands"), classes.select("cls"), "cls")
        texts = rows.select(F.col("__row").alias("cls"), F.col("text").cast("string").alias("text"))
        edges = materialize(near_code_edges(materialize(classes.select("code").distinct()), radius))
        edges = resemblance_edges(texts, bands, edges, shingle_words, similarity)
        rooted = classes.join(connected_components(edges).withColumnRenamed("node", "code"), "code", "left")
        first = rooted.groupBy(F.coalesce("root", "code")).agg(F.min("best").alias("best"))
        return rows_in(rows, first.select("best.row"), "__row", numbers).drop("__sketch", "__row")


def simhash_components(docs: DataFrame, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    component_id is the smallest doc_id reachable over links of ``radius`` bits
    or less. Null and empty texts have fingerprint 0, linked like any other.
    Repeated rows get one row each; rows without a doc_id take part and never
    give a component its name (which is null if no member has a doc_id).
    Other columns are not carried along; no rows give no rows.
    """
    prints = materialize(docs.select("doc_id", simhash(F.col("text").cast("string"), shingle_words).alias("code")))
    codes = materialize(prints.groupBy("code").agg(F.min("doc_id").alias("least")))
    found = code_components(codes.select("code"), radius)
    rooted = codes.join(found, "code", "left").select("code", "least", F.coalesce("root", "code").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_code = rooted.join(named, "root").select("code", "component_id")
    return prints.join(of_code, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
