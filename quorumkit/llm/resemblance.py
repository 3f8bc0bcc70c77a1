"""Links between texts whose sets of word shingles overlap.

Sixty-four minima of hashed shingles make sixteen bands of four; two texts with
a Jaccard similarity of 0.8 agree on at least one band in all but two of ten
thousand cases. Bands only propose: every link is decided on the whole shingle
sets. Texts that are in one component already are not compared again, so copies
of one text cost one comparison each with the first of their bucket, and buckets
that still hold several components compare those of their rows that share one of
their rarest shingles, which loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release_memory, shuffle_partitions
from .components import connected_components
from .lookup import rows_in

BANDS, BAND_ROWS = 16, 4
#: Shingles of a bucket's chunk; larger buckets are cut, and each pair of chunks is a bucket of its own.
CHUNK_SHINGLES = 1_000_000
_SLICE, _MIN_SLICE = 1 << 16, 1 << 12
_NUMBERS = np.random.default_rng(17).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)
_MASKS, _FACTORS = _NUMBERS[0], _NUMBERS[1] | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as bytes, A-Z in lower case; only ASCII white space parts them."""
    return (text or "").encode("utf-8").lower().split()


def shingle_hashes(words: list[bytes], shingle_words: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of words, in slices; fewer words are one run, none give none."""
    if not words:
        return
    line, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SLICE):
        spans = zip(starts[at : at + _SLICE].tolist(), ends[at : at + _SLICE].tolist())
        yield np.array([digest(line[a:b], 42) for a, b in spans], "<u8")


class Minima:
    """Least values of the hashed shingles, fed slice by slice."""

    def __init__(self) -> None:
        self.least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)

    def feed(self, hashes: np.ndarray) -> None:
        for at in range(0, len(hashes), _MIN_SLICE):
            mixed = (hashes[at : at + _MIN_SLICE, None] ^ _MASKS) * _FACTORS
            np.minimum(self.least, mixed.min(0), out=self.least)

    def bands(self) -> list[int]:
        """One signed 64-bit key for each band."""
        parts = self.least.reshape(BANDS, BAND_ROWS)
        keys = np.array([xxhash.xxh64_intdigest(p.tobytes(), i) for i, p in enumerate(parts)], np.uint64)
        return keys.view(np.int64).tolist()


def shingle_set(text: Column, shingle_words: int) -> Column:
    """Distinct hashed shingles of each text, sorted."""

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        parts, ends = [np.zeros(0, np.uint64)], [0]
        for t in texts:
            found = list(shingle_hashes(words_of(t.as_py()), shingle_words))
            parts.append(np.unique(np.concatenate(found)) if found else parts[0])
            ends.append(ends[-1] + len(parts[-1]))
        out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))
        release_memory()
        return out

    return run(text)


def alike(common: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """True where sets of sizes a and b with so many common members have that Jaccard similarity."""
    return common >= similarity * (a + b - common) - 1e-9


class _Prefixes:
    """An index of the rows of a bucket by their rarest shingles.

    With all shingles in one order, two sets of similarity t share a shingle
    among the first size - ceil(t * size) + 1 of each. Rarest first, so what all
    rows of a bucket share is looked up by none that has enough of its own.
    """

    def __init__(self, roots: np.ndarray, sizes: np.ndarray, flat: np.ndarray, similarity: float):
        token, count = np.unique(flat, return_inverse=True, return_counts=True)[1:]
        place = np.empty(len(count), np.int64)
        place[np.argsort(count, kind="stable")] = np.arange(len(count))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((place[token], owner))
        rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        length = sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1
        first = rank < length[owner]  # owner is the same before and after the sorting
        self.token, self.row = place[token[order]][first], owner[first]
        self.ends = np.cumsum(np.bincount(self.row, minlength=len(sizes)))
        # postings in the order of token, root and row, so a row's own component is one stretch to leave out
        self.base = int(roots.max()) + 1
        key = self.token * self.base + roots[self.row]
        by = np.argsort(key, kind="stable")
        self.key, self.posted = key[by], self.row[by]

    def partners(self, i: int, root: int) -> Iterator[np.ndarray]:
        """For each of the first shingles of row i the rows of other roots that have it among theirs, rarest shingle first."""
        mine = self.token[(self.ends[i - 1] if i else 0) : self.ends[i]]
        low, high = np.searchsorted(self.key, mine * self.base), np.searchsorted(self.key, (mine + 1) * self.base)
        own, after = np.searchsorted(self.key, mine * self.base + root), np.searchsorted(self.key, mine * self.base + root, "right")
        for a, b, c, d in zip(low.tolist(), own.tolist(), after.tolist(), high.tolist()):
            if b - a + d - c:
                yield np.concatenate([self.posted[a:b], self.posted[c:d]])


def link_sets(roots: np.ndarray, sizes: np.ndarray, flat: np.ndarray, similarity: float, chunk: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links (row, row) of one bucket between rows of different roots.

    ``flat`` holds the rows' distinct shingles one after the other. Rows of one
    chunk are compared with each other only if the bucket holds no second chunk.
    A row is compared with those alone that share one of its rarest shingles.
    """
    comp = np.unique(roots, return_inverse=True)[1]
    members = {c: np.flatnonzero(comp == c) for c in range(comp.max() + 1)} if len(comp) else {}
    if len(members) < 2:
        return []
    index, fixed = _Prefixes(comp, sizes, flat, similarity), comp.copy()
    starts, crossed, links = np.cumsum(sizes) - sizes, len(np.unique(chunk)) > 1, []
    met = np.full(len(sizes), -1)

    def near(i: int, some: np.ndarray) -> np.ndarray:
        mine, n = np.sort(flat[starts[i] : starts[i] + sizes[i]]), sizes[some]
        theirs = flat[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        common = np.add.reduceat((mine[at] == theirs).astype(np.int64), np.cumsum(n) - n)
        return some[alike(common, sizes[i], n, similarity)]

    for i in range(len(sizes)):
        if len(members) < 2:
            break
        for rows in index.partners(i, int(fixed[i])):
            some = rows[(rows < i) & (met[rows] != i) & (comp[rows] != comp[i])]
            if crossed:
                some = some[chunk[some] != chunk[i]]
            some = some[(sizes[some] >= similarity * sizes[i] - 1e-9) & (sizes[i] >= similarity * sizes[some] - 1e-9)]
            # one of each component first, as a link settles all of its rows; then the rows of components without one
            first = np.zeros(len(some), bool)
            first[np.unique(comp[some], return_index=True)[1]] = True
            for part in (some[first], some[~first]):
                part = part[comp[part] != comp[i]]
                if not len(part):
                    continue
                met[part] = i
                for j in near(i, part).tolist():
                    if comp[j] != comp[i]:
                        small, large = sorted((int(comp[i]), int(comp[j])), key=lambda c: len(members[c]))
                        comp[members[small]] = large
                        members[large] = np.concatenate([members[large], members.pop(small)])
                        links.append((i, j))
    return links


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (cls, code, root, band) of the buckets that hold more than one component, with the bucket's first row."""
    several = rows.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    hit = materialize(rows.join(several.select("band"), "band", "left_semi"))
    first = hit.groupBy("band").agg(F.min(F.struct("root", "cls", "code")).alias("first"))
    return materialize(hit.join(first, "band"))


def _rooted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with the root of their code's component, or the code itself."""
    of_code = connected_components(edges).withColumnRenamed("node", "code")
    return nodes.join(of_code, "code", "left").withColumn("root", F.coalesce("root", "code"))


def resemblance_edges(texts: DataFrame, bands: DataFrame, edges: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """edges (a, b) with those added that join texts of at least that similarity.

    texts: cls and text, where cls is a row number for ``rows_in``. bands: cls,
    code and bands, a row for each text; code is the node that a text belongs
    to. edges: links known before. Texts of one node are never compared; texts
    without words have no bands. Texts are read where they lie; their shingles
    move only as far as they are compared.
    """
    rows = _mixed(_rooted(bands, edges).select("cls", "code", "root", F.explode("bands").alias("band")))
    sets = materialize(rows_in(texts, rows.select("cls").distinct(), "cls").select("cls", shingle_set(F.col("text"), shingle_words).alias("shingles")))
    pairs = rows.where(F.col("root") != F.col("first.root")).select(F.col("cls").alias("x"), F.col("code").alias("a"), F.col("first.cls").alias("y"), F.col("first.code").alias("b"))
    pairs = materialize(pairs.distinct())
    first_sets, other_sets = (rows_in(sets, pairs.select(side).distinct(), "cls").select(F.col("cls").alias(side), F.col("shingles").alias(f"s{side}")) for side in "yx")
    both = pairs.join(other_sets, "x").join(first_sets, "y")
    common = F.size(F.array_intersect("sx", "sy"))
    near = both.where(common >= F.lit(similarity) * (F.size("sx") + F.size("sy") - common) - 1e-9)
    edges = materialize(edges.select("a", "b").unionByName(near.select("a", "b")))

    left = _mixed(_rooted(rows.select("cls", "code", "band"), edges)).select("cls", "code", "band", "root")
    sets = rows_in(sets, left.select("cls").distinct(), "cls")
    sized = left.join(sets.select("cls", F.size("shingles").alias("n")), "cls")
    cuts = sized.groupBy("band").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: F.xxhash64("band", F.least(i, own), F.greatest(i, own)))
    whole = left.join(cuts, "band").withColumn("chunk", own)
    dealt = whole.select("cls", "code", "root", "chunk", F.explode(F.when(F.col("chunks") > 1, pair).otherwise(F.array("band"))).alias("bucket"))
    dealt = dealt.join(sets, "cls").repartition(shuffle_partitions(texts.sparkSession), "bucket").sortWithinPartitions("bucket")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def run() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            codes, roots, chunk = (table.column(c).to_numpy() for c in ("code", "root", "chunk"))
            lists = table.column("shingles").combine_chunks()
            found = link_sets(roots, lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy(), similarity, chunk)
            at = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(codes[at[:, 0]]), pa.array(codes[at[:, 1]])], names=["a", "b"])

        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if held and held[-1].column("bucket")[0] != batch.column("bucket")[begin]:
                    yield run()
                    held = []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield run()

    more = dealt.select("bucket", "code", "root", "chunk", "shingles").mapInArrow(link, "a long, b long")
    return materialize(edges.unionByName(more.distinct()))
