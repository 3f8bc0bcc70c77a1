"""Removal of repeated word windows by Rabin-Karp hashes.

Every window of so many consecutive words gets a polynomial hash that is made of
its words' hashes by doubling. A task leaves out the windows that one of its
slices of text already holds, so a passage that is everywhere leaves it once a
slice, and deals the rest to buckets of bounded size; a second polynomial
chooses the bucket, so equality is that of 64 bits and of the bucket. A bucket
counts its hashes; of each that it holds more than once the earliest window
stays, and all others go back to their documents, where neighbouring windows
merge into the longest intervals to remove.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quorumkit.operators.ranking import running_sum

from .common import release_memory, shuffle_partitions, text_or_empty
from .ragged import Ragged, raw_bytes, slices
from .spans import WORD_BASES, byte_table, mix, pack, unpack, window_hashes, word_hashes, word_spans

#: Bytes of text whose windows are one bucket, and bytes of text that are cut together.
BUCKET_BYTES, GROUP_BYTES = 12 << 20, 8 << 20
#: Windows that a task holds at once.
CHUNK_WORDS = 1 << 20
#: The white space that parts words.
SPACE = byte_table(b" \t\n\x0b\x0c\r")
_OPEN, _REPEAT = 0, 1
_BLOCK = "kind int, bucket int, n int, hashes binary, keys binary, starts binary"
_SPANS = "array<struct<start:long,end:long>>"
WORK = ("n_words", "n_removed", "removed_spans", "kept")


def _block(kind: int, bucket: int, hashes: np.ndarray | None, keys: np.ndarray, starts: np.ndarray) -> list:
    return [kind, bucket, len(keys), b"" if hashes is None else hashes.tobytes(), pack(keys), pack(starts)]


def _batch(blocks: list[list]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), types)], names=["kind", "bucket", "n", "hashes", "keys", "starts"])


def _window_blocks(size: int, buckets: int):
    """Of each slice of texts the first window of every hash, dealt to buckets, and the places of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, all_keys = 0, batch.column("key").to_numpy()
            for texts in slices(batch.column("text")):
                keys = all_keys[at : at + len(texts)]
                at += len(texts)
                order = np.argsort(keys, kind="stable")  # windows then stand in the order of documents and places
                raw = raw_bytes(texts).take(order)
                starts, ends, per_doc = word_spans(raw.values, raw.lengths, SPACE)
                x, doc = word_hashes(raw.values, starts, ends), np.repeat(np.arange(len(keys)), per_doc)
                first = np.cumsum(per_doc) - per_doc
                del raw, starts, ends
                for low in range(0, max(0, len(x) - size + 1), CHUNK_WORDS):
                    part = slice(low, low + CHUNK_WORDS + size - 1)
                    whole = doc[part][: len(x[part]) - size + 1] == doc[part][size - 1 :]
                    place = low + np.flatnonzero(whole)
                    if not len(place):
                        continue
                    h, h2 = (window_hashes(x[part], size, base)[whole] for base in WORD_BASES)
                    own, start = keys[order][doc[place]].astype(np.int64), (place - first[doc[place]]).astype(np.int32)
                    bucket = (mix(h2) % np.uint64(buckets)).astype(np.int32)
                    by_hash = np.lexsort((bucket, h))
                    again = np.zeros(len(h), bool)
                    again[by_hash[1:]] = (h[by_hash][1:] == h[by_hash][:-1]) & (bucket[by_hash][1:] == bucket[by_hash][:-1])
                    blocks = []
                    if again.any():
                        blocks.append(_block(_REPEAT, int(bucket[0]), None, own[again], start[again]))
                    kept = np.flatnonzero(~again)
                    kept = kept[np.argsort(bucket[kept], kind="stable")]
                    cuts = [0, *(np.flatnonzero(np.diff(bucket[kept])) + 1).tolist(), len(kept)]
                    for a, b in zip(cuts, cuts[1:]):
                        i = kept[a:b]
                        blocks.append(_block(_OPEN, int(bucket[i[0]]), h[i], own[i], start[i]))
                    yield _batch(blocks)
            release_memory()

    return run


def group_of(keys: np.ndarray, groups: int) -> np.ndarray:
    """The number of the group in which a key's text is cut; ``group_column`` says the same."""
    k = keys.view(np.uint64)
    for shift in (32, 16, 8):
        k = k ^ (k >> np.uint64(shift))
    return (k & np.uint64((1 << 62) - 1)).astype(np.int64) % groups


def group_column(key: Column, groups: int) -> Column:
    for shift in (32, 16, 8):
        key = key.bitwiseXOR(F.shiftrightunsigned(key, shift))
    return F.pmod(key.bitwiseAND(F.lit((1 << 62) - 1)), F.lit(groups).cast("long"))


def _count_buckets(groups: int):
    """Places of windows whose hash stands earlier too, as packed rows for each group of documents."""

    def earlier(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        h, keys, starts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        twin = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        twin = twin[np.lexsort((starts[twin], keys[twin], h[twin]))]
        late = twin[1:][h[twin][1:] == h[twin][:-1]]
        return keys[late], starts[late]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, now = [], [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                done.append(earlier(held))
            if done:
                keys, starts = (np.concatenate(x) for x in zip(*done))
                group = group_of(keys, groups)
                order = np.lexsort((starts, keys, group))
                keys, starts, group = keys[order], starts[order], group[order]
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
                rows = [[int(group[a]), b - a, pack(keys[a:b]), pack(starts[a:b])] for a, b in zip(cuts, cuts[1:]) if b > a]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["group", "n", "keys", "starts"])
            held.clear()
            done.clear()
            release_memory()

        for batch in batches:
            for kind, bucket, n, hashes, keys, starts in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if bucket != now:
                    yield from flush()
                    now = bucket
                place = unpack(keys, n, np.int64), unpack(starts, n, np.int32)
                if kind == _REPEAT:
                    done.append(place)
                else:
                    held.append((np.frombuffer(hashes, np.uint64), *place))
        yield from flush()

    return run


def _squeezed(text: Column) -> Column:
    """Each text by itself in compressed form, for its way to its group."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([pa.compress(t.as_py().encode(), codec="zstd", asbytes=True) for t in texts], pa.binary())

    return run(text)


def _cut(raw: Ragged, removed: np.ndarray, size: int) -> list[pa.Array]:
    """n_words, n_removed, removed_spans and kept of texts; ``removed``: numbers of the windows (by their first word among all words)."""
    data, n = raw.values, len(raw.lengths)
    starts, ends, per_doc = word_spans(data, raw.lengths, SPACE)
    doc = np.repeat(np.arange(n), per_doc)
    step = np.bincount(removed, minlength=len(starts) + 1) - np.bincount(removed + size, minlength=len(starts) + 1) if len(removed) else np.zeros(len(starts) + 1, int)
    gone = np.cumsum(step)[: len(starts)] > 0
    first = np.cumsum(per_doc) - per_doc
    new_doc = np.zeros(len(starts) + 1, bool)
    new_doc[np.concatenate([first, [len(starts)]])] = True
    begin = np.flatnonzero(gone & (new_doc[:-1] | ~np.concatenate([[False], gone[:-1]])))
    end = np.flatnonzero(gone & (new_doc[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
    spans = pa.StructArray.from_arrays([pa.array(begin - first[doc[begin]]), pa.array(end - first[doc[begin]])], names=["start", "end"])
    edges = np.concatenate([[0], np.cumsum(np.bincount(doc[begin], minlength=n))])
    stay = np.flatnonzero(~gone)
    letters = np.zeros(len(data) + 1, np.int8)  # +1 where a kept word begins, -1 where it ends
    letters[starts[stay]] += 1
    letters[ends[stay]] -= 1
    chosen = np.cumsum(letters[:-1], dtype=np.int8).astype(bool)
    followed = stay[:-1][doc[stay[1:]] == doc[stay[:-1]]]  # kept words after which another one of the document comes
    text = data.copy()
    text[ends[followed]] = 32
    chosen[ends[followed]] = True
    size_of = np.diff(np.concatenate([[0], np.cumsum(chosen)])[np.concatenate([[0], raw.ends])])
    offsets = np.concatenate([[0], np.cumsum(size_of)]).astype(np.int32)
    kept = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(text[chosen]))
    return [pa.array(per_doc.astype(np.int64)), pa.array(np.bincount(doc[gone], minlength=n)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans), kept]


def remove_repeated_windows(docs: DataFrame, words: int = 20) -> DataFrame:
    """Add n_words, n_removed, removed_spans (in words) and kept to each document.

    A word goes if it is covered by a window of ``words`` words whose sequence
    starts earlier too: in a document with a smaller doc_id or before it in the
    same one. Windows never cross documents and are judged on the input. A null
    text has no words, and a text with fewer words than a window loses none.
    Ids that are null come last; among rows of one id the order is that of a
    hash of their texts, so of wholly equal rows all but one lose every word
    that a window covers. Kept words are joined by one space. Other columns
    stay, those with the names of the added ones are replaced; no rows give no rows.
    """
    spark = docs.sparkSession
    base = docs.drop(*WORK)
    odd = base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    names = base.columns
    rest = [F.col(f"`{c}`") for c in names if c != "text"]
    rows = base.select("doc_id", "text", F.struct(*rest).alias("row"))
    if odd:  # the place among all rows then stands for the id
        keyed = running_sum(rows, [], [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")], name="key")
    else:
        keyed = rows.withColumn("key", F.col("doc_id").cast("long"))
    n_bytes = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(shuffle_partitions(spark), -(-n_bytes // BUCKET_BYTES))
    groups = max(shuffle_partitions(spark), -(-n_bytes // GROUP_BYTES)) | 1
    blocks = keyed.select("key", text_or_empty().alias("text")).mapInArrow(_window_blocks(words, buckets), _BLOCK)
    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    late = dealt.mapInArrow(_count_buckets(groups), "group long, n int, keys binary, starts binary")
    texts = keyed.select("row", "key", F.col("text").isNull().alias("null"), F.octet_length(text_or_empty()).alias("size"), _squeezed(text_or_empty()).alias("squeezed"), group_column(F.col("key"), groups).alias("group"))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(left.column("key").to_numpy(), kind="stable")
        left = left.take(pa.array(order))
        keys = left.column("key").to_numpy()
        packed = [(unpack(k, n, np.int64), unpack(s, n, np.int32)) for n, k, s in zip(*(right.column(c).to_pylist() for c in ("n", "keys", "starts")))]
        late_keys, late_starts = (np.concatenate(x) for x in zip(*packed)) if packed else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        by_key = np.argsort(late_keys, kind="stable")
        late_keys, late_starts = late_keys[by_key], late_starts[by_key]
        sizes, parts, at = left.column("size").to_numpy().astype(np.int64), [], 0
        while at < len(keys):
            end = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), GROUP_BYTES // 2, "right")) + at)
            raw_texts = [pa.decompress(z.as_py(), decompressed_size=int(s), codec="zstd", asbytes=True) for z, s in zip(left.column("squeezed")[at:end], sizes[at:end])]
            raw = Ragged(np.frombuffer(b"".join(raw_texts), np.uint8), sizes[at:end])
            per_doc = word_spans(raw.values, raw.lengths, SPACE)[2]
            a, b = np.searchsorted(late_keys, keys[at]), np.searchsorted(late_keys, keys[end - 1], "right")
            removed = (np.cumsum(per_doc) - per_doc)[np.searchsorted(keys[at:end], late_keys[a:b])] + late_starts[a:b]
            text = pa.array([None if null else t for null, t in zip(left.column("null")[at:end].to_pylist(), raw_texts)], pa.binary()).cast(pa.string())
            new = dict(zip(WORK, _cut(raw, removed, words)))
            parts.append(pa.table({"row": left.column("row")[at:end], "text": text, **new}))
            at = end
        release_memory()
        return pa.concat_tables(parts) if parts else empty

    schema = StructType([keyed.schema["row"], StructField("text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType()), *StructType.fromDDL(f"removed_spans {_SPANS}"), StructField("kept", StringType())])
    empty = to_arrow_schema(schema).empty_table()
    out = texts.groupBy("group").cogroup(late.groupBy("group")).applyInArrow(cut, schema)
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in names), *WORK)


def windows_digest(docs: DataFrame, words: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, the SHA-256 of the words that stay, their bytes, and whether any word was removed."""
    out = remove_repeated_windows(docs.select("doc_id", "text"), words)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"), (F.col("n_removed") > 0).alias("has_repeats"))


def windows_sql(words: int = 20) -> str:
    """The digest of ``documents`` in DuckDB's SQL; a window's text stands for its words."""
    return rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i : i + {words - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {words - 2})) AS i FROM d WHERE len(w) >= {words})),
    late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, i + unnest(range({words})) AS i FROM late),
    word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n, 0))::bigint AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, strlen(coalesce(t, ''))::bigint AS n_kept, len(w) > coalesce(n, 0) AS has_repeats
    FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""
