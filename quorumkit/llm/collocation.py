"""Phrases whose words stand together more often than their parts would by chance.

Texts are cut once into slices of one language. A phrase can only be frequent if
all its pairs of words are, so the first pass counts hashed pairs: slices send
each pair once, buckets add up, and a bit for each pair goes back to its slice. The second pass counts in the
same way the phrases all of whose pairs passed. A frequent phrase is then asked
of one slice that has it, which gives its text. A hash has 64 bits, and a second
polynomial chooses its bucket; both must agree.

Estimation works on sorted count streams, as external language-model estimators
lay them out: in prefix order the phrases that a phrase begins with stand before
it, in suffix order those that it ends with, so one walk along each stream gives
the counts of all left and all right parts, and the two streams are merged in
step. No table of counts is ever held or looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release_memory, shuffle_partitions
from .spans import WORD_BASES, byte_table, mix, pack, unpack, word_hashes, word_spans

#: Words of the longest phrase, the least number of occurrences of a candidate, and phrases reported for each language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of a slice, bytes of text whose pairs are one bucket, and phrase occurrences whose texts are made at once.
SLICE_BYTES, BUCKET_BYTES, STEP = 4 << 20, 12 << 20, 1 << 19
#: What ends a piece, and what parts words inside it.
ENDS, GAPS = byte_table(b".,;:!?\n\x0b\x0c\r"), byte_table(b" \t")
_SLICE = "lang string, n_words long, n_bytes int, data binary"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Runs into which a language's phrases are dealt before its best are chosen.
_SALTS = 64


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lower-cased texts of one language joined by a line end, in compressed slices; a long text is cut where a piece ends."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(langs.indices, i))
            data = _LOWER[np.frombuffer("\n".join(texts.to_pylist()).encode(), np.uint8)]
            cuts = np.flatnonzero(ENDS[data]) + 1
            at = 0
            while at < len(data):
                end = len(data)
                if end - at > SLICE_BYTES:
                    fit = np.searchsorted(cuts, at + SLICE_BYTES, "right")
                    later = cuts[fit - 1] if fit and cuts[fit - 1] > at else (cuts[fit] if fit < len(cuts) else end)
                    end = int(later)
                part = data[at:end]
                at = end
                n = len(word_spans(part, np.array([len(part)]), GAPS | ENDS)[0])
                if n:
                    row = [lang], [n], [len(part)], [pa.compress(part.tobytes(), codec="zstd", asbytes=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.binary()))], names=["lang", "n_words", "n_bytes", "data"])
        release_memory()


class _Words:
    """The words of a slice and where pairs of neighbours lie in one piece."""

    def __init__(self, data: bytes, n_bytes: int):
        self.data = np.frombuffer(pa.decompress(data, decompressed_size=n_bytes, codec="zstd", asbytes=True), np.uint8)
        self.starts, self.ends, _ = word_spans(self.data, np.array([n_bytes]), GAPS | ENDS)
        piece = np.cumsum(ENDS[self.data])[self.starts]
        self.together = piece[1:] == piece[:-1]  # word i and i + 1

    def hashes(self, lang: str, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, first words, hashes, buckets) of all phrases of 2 to ``longest`` words in one piece; languages and sizes differ."""
        x = word_hashes(self.data, self.starts, self.ends)
        own = word_hashes(np.frombuffer(b"=" + lang.encode(), np.uint8), np.array([0]), np.array([1 + len(lang.encode())]))[0]
        sums, inside = [x, x], np.ones(len(x), bool)
        for size in range(2, longest + 1):
            if len(x) < size:
                return
            sums = [h[:-1] * np.uint64(base) + x[size - 1 :] for h, base in zip(sums, WORD_BASES)]
            inside = inside[:-1] & self.together[size - 2 :]
            first = np.flatnonzero(inside)
            h1, h2 = (mix(h[first] + own + np.uint64(size)) for h in sums)
            yield size, first, h1, (h2 % np.uint64(buckets)).astype(np.int32)

    def phrases(self, first: np.ndarray, size: int) -> Iterator[pa.StringArray]:
        """Texts of the phrases of ``size`` words that begin at words ``first``, some at a time."""
        length = self.ends - self.starts
        flat = np.cumsum(length + 1) - (length + 1)  # places when one space follows each word
        line = np.full(int(length.sum()) + len(length), 32, np.uint8)
        inside = np.ones(len(line), bool)
        inside[flat + length] = False
        letter = np.zeros(len(self.data) + 1, np.int8)
        letter[self.starts] += 1
        letter[self.ends] -= 1
        line[inside] = self.data[np.cumsum(letter[:-1], dtype=np.int8).astype(bool)]
        for at in range(0, len(first), STEP):
            a = flat[first[at : at + STEP]]
            last = first[at : at + STEP] + size - 1
            n = flat[last] + length[last] - a
            text = line[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            yield pa.StringArray.from_buffers(len(n), pa.py_buffer(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.py_buffer(text))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, n, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "n_bytes", "data"))):
            words = _Words(data, n)
            for texts in words.phrases(np.arange(len(words.starts)), 1):
                counted = texts.value_counts()
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(counted)), counted.field("values"), counted.field("counts")], names=["lang", "phrase", "n"])
        release_memory()


class _Distinct:
    """The different phrases among some, in the order of buckets and hashes, and which of them each phrase is."""

    def __init__(self, h: np.ndarray, bucket: np.ndarray):
        order = np.lexsort((h, bucket))
        new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])])[: len(h)]
        first = np.flatnonzero(new)
        self.h, self.bucket = h[order][first], bucket[order][first]
        self.count = np.diff(np.append(first, len(h))).astype(np.int32)
        self.which = np.empty(len(h), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def blocks(self, number: int) -> Iterator[pa.RecordBatch]:
        """One row for each bucket: the slice's number, hashes and counts."""
        cuts = [0, *(np.flatnonzero(np.diff(self.bucket)) + 1).tolist(), len(self.h)]
        rows = [[int(self.bucket[a]), number, b - a, self.h[a:b].tobytes(), pack(self.count[a:b])] for a, b in zip(cuts, cuts[1:]) if b > a]
        if rows:
            yield _batch(rows, ("bucket", "slice", "n", "hashes", "counts"), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))


_BLOCK = "bucket int, slice long, n int, hashes binary, counts binary"


def _batch(rows: list[list], names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


def _pair_blocks(buckets: int):
    """The pairs of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, n, data, number in zip(*(batch.column(c).to_pylist() for c in ("lang", "n_bytes", "data", "slice"))):
                for _, _, h, bucket in _Words(data, n).hashes(lang, 2, buckets):
                    yield from _Distinct(h, bucket).blocks(number)
            release_memory()

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Of each bucket its blocks (slice, n), all their hashes and all their counts."""
    held, now = [], None
    for batch in batches:
        for bucket, number, n, hashes, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "slice", "n", "hashes", "counts"))):
            if bucket != now and held:
                yield now, [x[:2] for x in held], *(np.concatenate(c) for c in zip(*(x[2:] for x in held)))
                held = []
            now = bucket
            held.append((number, n, np.frombuffer(hashes, np.uint64), unpack(counts, n, np.int32).astype(np.int64)))
    if held:
        yield now, [x[:2] for x in held], *(np.concatenate(c) for c in zip(*(x[2:] for x in held)))


def _frequent_bits(least: int):
    """Of each block a bit for each phrase: whether all slices together have it often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks, h, counts in _by_bucket(batches):
            found = np.unique(h, return_inverse=True)[1]
            often = (np.bincount(found, counts).astype(np.int64) >= least)[found]
            rows, at = [], 0
            for number, n in blocks:
                bits = often[at : at + n]
                rows.append([number, bucket, n, np.packbits(bits).tobytes() if bits.any() else b""])
                at += n
            yield _batch(rows, ("slice", "bucket", "n", "bits"), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))
            release_memory()

    return run


def _phrase_blocks(longest: int, buckets: int):
    """The phrases of each slice all of whose pairs are frequent by the slice's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, n, data, number, replies in zip(*(batch.column(c).to_pylist() for c in ("lang", "n_bytes", "data", "slice", "replies"))):
                words, found = _Words(data, n), []
                good = run_on = np.zeros(len(words.starts), bool)
                often = np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) if r["bits"] else np.zeros(r["n"], np.uint8) for r in replies])
                for size, first, h, bucket in words.hashes(lang, longest, buckets):
                    if size == 2:
                        good[first] = often[_Distinct(h, bucket).which] > 0
                        run_on = good
                    else:
                        run_on = run_on[:-1] & good[size - 2 :][: len(run_on) - 1]
                    keep = run_on[first]
                    found.append((h[keep], bucket[keep]))
                h, bucket = map(np.concatenate, zip(*found))
                yield from _Distinct(h, bucket).blocks(number)
            release_memory()

    return run


def _asked(least: int):
    """Frequent phrases, each asked of one slice that has it, chosen by lot so that no slice is asked for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks, h, counts in _by_bucket(batches):
            numbers = np.repeat([number for number, _ in blocks], [n for _, n in blocks])
            distinct, found = np.unique(h, return_inverse=True)
            total = np.bincount(found, counts).astype(np.int64)
            some = np.flatnonzero(total[found] >= least)
            order = some[np.lexsort((mix(numbers[some].astype(np.uint64) ^ h[some]), h[some]))]
            one = order[np.concatenate([[True], h[order][1:] != h[order][:-1]])[: len(order)]]
            one = one[np.argsort(numbers[one], kind="stable")]
            cuts = [0, *(np.flatnonzero(np.diff(numbers[one])) + 1).tolist(), len(one)]
            rows = [[int(numbers[one[a]]), bucket, h[one[a:b]].view(np.int64).tolist(), total[found[one[a:b]]].tolist()] for a, b in zip(cuts, cuts[1:]) if b > a]
            if rows:
                yield _batch(rows, ("slice", "bucket", "hashes", "totals"), (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())))
            release_memory()

    return run


def _phrase_texts(longest: int, buckets: int):
    """Texts and counts of the phrases that a slice was asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, n, data, asked in zip(*(batch.column(c).to_pylist() for c in ("lang", "n_bytes", "data", "asked"))):
                words = _Words(data, n)
                totals = {(h, r["bucket"]): a for r in asked for h, a in zip(r["hashes"], r["totals"])}
                known = np.array([h for h, _ in totals], np.int64).view(np.uint64)
                for size, first, h, bucket in words.hashes(lang, longest, buckets):
                    at = np.flatnonzero(np.isin(h, known))
                    at = at[np.unique(np.stack([h[at], bucket[at].astype(np.uint64)]), axis=1, return_index=True)[1]]
                    counts = [totals.get(key) for key in zip(h[at].view(np.int64).tolist(), bucket[at].tolist())]
                    mine = np.array([c is not None for c in counts], bool)
                    texts = [t for part in words.phrases(first[at[mine]], size) for t in part.to_pylist()] if mine.any() else []
                    if texts:
                        rows = [[lang, t, size, a] for t, a in zip(texts, filter(None, counts))]
                        yield _batch(rows, ("lang", "phrase", "size", "a"), (pa.string(), pa.string(), pa.int32(), pa.int64()))
            release_memory()

    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, a) of all phrases with a >= least, and (lang, n) with each language's words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    sliced = materialize(texts.mapInArrow(_slices, _SLICE).withColumn("slice", F.monotonically_increasing_id()))
    totals = sliced.groupBy("lang").agg(F.sum("n_words").alias("n"))
    n_bytes = sliced.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(shuffle_partitions(spark), -(-n_bytes // BUCKET_BYTES))
    often = F.col("a") >= least
    words = sliced.select("lang", "n_bytes", "data").mapInArrow(_word_counts, "lang string, phrase string, n long")
    words = words.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(often).select("lang", "phrase", F.lit(1).alias("size"), "a")
    deal = lambda blocks: blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    gather = lambda rows, *columns: rows.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
    bits = deal(sliced.select("lang", "n_bytes", "data", "slice").mapInArrow(_pair_blocks(buckets), _BLOCK)).mapInArrow(_frequent_bits(least), "slice long, bucket int, n int, bits binary")
    checked = sliced.join(gather(bits, "bucket", "n", "bits"), "slice").select("lang", "n_bytes", "data", "slice", F.col("rows").alias("replies"))
    asked = deal(checked.mapInArrow(_phrase_blocks(longest, buckets), _BLOCK)).mapInArrow(_asked(least), "slice long, bucket int, hashes array<long>, totals array<long>")
    told = sliced.join(gather(asked, "bucket", "hashes", "totals"), "slice").select("lang", "n_bytes", "data", F.col("rows").alias("asked"))
    phrases = told.mapInArrow(_phrase_texts(longest, buckets), "lang string, phrase string, size int, a long")
    return materialize(words.unionByName(phrases)), totals


def _stream(grams: DataFrame, key: Column, longest: int, name: str) -> DataFrame:
    """lang, phrase and, for each j, the count of the phrase's first j parts in this order (``name`` with j), read off the sorted stream.

    The last phrase of j words before a longer one is its own beginning, since
    that is frequent too; where it stands in an earlier partition, the last such
    phrase of all earlier partitions is the one.
    """
    ranged = grams.withColumn("key", key).repartitionByRange("lang", "key").sortWithinPartitions("lang", "key")
    at = F.monotonically_increasing_id()
    ranged = materialize(ranged.withColumns({"part": F.shiftright(at, 33), "pos": at}))
    sizes = range(1, longest)
    count = {j: F.when(F.col("size") == j, F.col("a")) for j in sizes}
    before = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    here = ranged.select("*", *(F.last(count[j], ignorenulls=True).over(before).alias(f"in{j}") for j in sizes))
    tails = ranged.groupBy("part").agg(*(F.max_by(count[j], F.when(F.col("size") == j, F.col("pos"))).alias(f"t{j}") for j in sizes))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    carried = tails.select("part", *(F.last(f"t{j}", ignorenulls=True).over(earlier).alias(f"c{j}") for j in sizes))
    parts = [F.when(F.col("size") > j, F.coalesce(f"in{j}", f"c{j}")).alias(f"{name}{j}") for j in sizes]
    return here.join(carried, "part").select("lang", "phrase", "size", "a", *parts)


def exact_score() -> Column:
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    return F.expr("(cast(a * 1000 AS decimal(19, 0)) * cast(n AS decimal(19, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends,
    and pieces into words at spaces and tabs; a null lang is 'und', a null text
    is left out. A candidate occurs ``least`` times. Its score is
    floor(1000 * a * n / (l * r)) at the cut that makes it least (of equal
    scores the first cut). A candidate goes if a longer one holds its words and
    occurs as often. Products are exact (38 digits). Repeated rows count as
    often as they are there; other columns do not count; no rows give no rows.
    """
    grams, totals = phrase_counts(docs, longest, least)
    words = F.split("phrase", " ", -1)
    left = _stream(grams, words, longest, "l").where("size > 1")
    right = _stream(grams, F.reverse(words), longest, "r").where("size > 1").select("lang", "phrase", *(f"r{j}" for j in range(1, longest)))
    both = materialize(left.join(right.hint("merge"), ["lang", "phrase"]).join(totals, "lang"))

    def cut(k: int) -> Column:
        rest = F.coalesce(*(F.when(F.col("size") == m, F.col(f"r{m - k}")) for m in range(k + 1, longest + 1)))
        return F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), rest.alias("r")))

    cuts = both.withColumn("cut", F.explode(F.array_compact(F.array(*map(cut, range(1, longest))))))
    cuts = cuts.select("lang", "phrase", "size", "a", "n", "cut.*").withColumn("score", exact_score())
    scored = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # the words of a candidate that begin or end a longer one which occurs as often
    shorter = lambda part, size: F.array_join(F.slice(words, part, F.col("size") - 1), " ").alias("phrase")
    inner = [both.where((F.col("size") == m) & (F.col("a") == F.col(f"{side}{m - 1}"))).select("lang", shorter(1 if side == "l" else 2, m)) for m in range(3, longest + 1) for side in "lr"]
    held = scored
    if inner:
        covered = inner[0]
        for more in inner[1:]:
            covered = covered.unionByName(more)
        held = scored.join(covered.distinct(), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    flat = held.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).alias("salt"))
    few = flat.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """The phrases of ``documents`` in DuckDB's SQL, for phrases of up to five words."""
    grams = " UNION ALL ".join(f"SELECT lang, array_to_string(w[i : i + {m - 1}], ' ') AS phrase, {m} AS size FROM (SELECT lang, w, unnest(range(1, len(w) - {m - 2})) AS i FROM pieces WHERE len(w) >= {m})" for m in range(1, 6))
    return rf"""WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts)),
    f AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS a FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
    n AS (SELECT lang, sum(len(w))::bigint AS n FROM pieces GROUP BY lang),
    cuts AS (SELECT lang, phrase, size, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1 : size], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)),
    scored AS (SELECT c.lang, c.phrase, c.size, c.a, k, l.a AS l, r.a AS r, n, ((1000 * c.a::hugeint * n) // (l.a::hugeint * r.a))::bigint AS score FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = x JOIN f r ON r.lang = c.lang AND r.phrase = y JOIN n ON n.lang = c.lang),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored) WHERE o = 1),
    held AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.size > b.size AND f.a >= b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM held)
    SELECT lang, rank::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n, score FROM ranked WHERE rank <= {top}"""
