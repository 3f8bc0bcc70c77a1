"""Byte-pair encoding and decoding with a published vocabulary file.

Words are merged with contiguous rank arrays: the part boundaries of a word and
the rank of each adjacent pair stand side by side, the smallest rank is found
by scanning, its boundary is deleted and the two neighbouring ranks are looked
up again. All short words of a slice of text go through these steps together,
one row of a matrix each, and each distinct word once. A run of letters or
symbols longer than ``LONG_WORD`` bytes goes through the same merges with a
heap, because a quadratic scan would not end on a 100 kB "word".

Nothing is kept from slice to slice, so memory depends on ``ragged.SLICE_BYTES`` and
the longest text alone.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, worker_object
from .ragged import SPACE, Ragged, raw_bytes, slices, split_words

#: Words of more bytes than this are merged with a heap instead of a scan.
LONG_WORD = 64
#: Widths of the matrices that words are merged in; a word takes the least that holds it.
_WIDTHS = (*range(1, 17), 20, 24, 32, 48, LONG_WORD)
_SHIFT, _MASK, _NONE = 20, (1 << 20) - 1, 1 << 60
#: Letters and numbers that Unicode 16 added and Python 3.13 does not know yet, as ranges.
UNICODE_16_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
UNICODE_16_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Capitals whose small letters Python 3.13 does not know yet (first, last, first small letter).
NEW_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5),
    (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
#: What is a piece of its own behind an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache
def _classes() -> np.ndarray:
    """Class of each code point: 0 white space, 1 letter, 2 number, 3 any other."""
    initials = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(0x110000)], np.uint8)
    for number, ranges in ((1, UNICODE_16_LETTERS), (2, UNICODE_16_NUMBERS)):
        for low, high in ranges:
            initials[low : high + 1] = number
    initials[list(map(ord, SPACE))] = 0
    return initials


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a vocabulary of lower-case words with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = dict(model["vocab"])
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab.update(self.special)
        self.token = [""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            self.token[i] = text
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._first = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        self._last = np.array([vocab[c + self.suffix] for c in byte_alphabet()], np.int64)
        #: Sorted pairs of ids, and for each its rank and the merged id in one number, so the least value is the least rank.
        a, b, made = np.array(pairs, np.int64).reshape(-1, 3).T
        key = a << _SHIFT | b
        order = np.argsort(key)
        self.keys, self.ranks = np.append(key[order], _NONE), np.append((np.arange(len(key)) << _SHIFT | made)[order], _NONE)
        self._spelled = raw_bytes(pa.array([t + " " for t in self.token]))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of each adjacent pair, or a number above all."""
        key = left << _SHIFT | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, words: pa.Array) -> Ragged:
        """Ids of pre-split, lower-case words."""
        raw = raw_bytes(words)
        begins = raw.ends - raw.lengths
        out, lengths = [], np.zeros(len(words), np.int64)
        low = 0
        for width in _WIDTHS:
            rows = np.flatnonzero((raw.lengths > low) & (raw.lengths <= width))
            for at in range(0, len(rows), 1 << 17):
                out.append(self._merge_rows(raw.values, begins[rows[at : at + (1 << 17)]], raw.lengths[rows[at : at + (1 << 17)]], width, rows[at : at + (1 << 17)]))
            low = width
        for row in np.flatnonzero(raw.lengths > LONG_WORD).tolist():
            data = raw.values[begins[row] : raw.ends[row]]
            parts = self._first[data]
            parts[-1] = self._last[data[-1]]
            got = np.array(self._merge_long(parts.tolist()), np.int32)
            out.append([(np.array([row]), got, np.array([len(got)]))])
        done = [x for group in out for x in group]
        for rows, _, n in done:
            lengths[rows] = n
        ends = np.cumsum(lengths)
        ids = np.zeros(ends[-1] if len(ends) else 0, np.int32)
        for rows, values, n in done:
            ids[np.repeat(ends[rows] - n - (np.cumsum(n) - n), n) + np.arange(len(values))] = values
        return Ragged(ids, lengths)

    def _merge_rows(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, width: int, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of up to ``width`` bytes, one in each row: (rows, their ids, numbers of ids)."""
        place = np.arange(width)
        within = place < lengths[:, None]
        parts = np.where(within, self._first[data[np.where(within, begins[:, None] + place, 0)]], -1)
        parts[np.arange(len(rows)), lengths - 1] = self._last[data[begins + lengths - 1]]
        pair = within[:, 1:]
        ranks = np.full(pair.shape, _NONE)
        ranks[pair] = self.rank(parts[:, :-1][pair], parts[:, 1:][pair])
        done = []
        while len(rows):
            w = parts.shape[1]
            if w == 1:
                done.append((rows, parts.ravel().astype(np.int32), np.ones(len(rows), np.int64)))
                break
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            ended = least == _NONE
            if ended.any():
                some = parts[ended]
                real = some >= 0
                done.append((rows[ended], some[real].astype(np.int32), real.sum(1)))
                rows, parts, ranks, at, least = (x[~ended] for x in (rows, parts, ranks, at, least))
            n = np.arange(len(rows))
            new = least & _MASK
            parts[n, at] = new
            keep = np.ones((len(rows), w), bool)  # the boundary behind the left part goes
            keep[n, at + 1] = False
            parts = parts[keep].reshape(len(rows), w - 1)
            keep = np.ones((len(rows), w - 1), bool)
            keep[n, at] = False
            ranks = ranks[keep].reshape(len(rows), w - 2)
            for has, left, right in ((at > 0, at - 1, at), (at < w - 2, at, at + 1)):
                i = n[has]
                right_part = parts[i, right[has]]
                ranks[i, left[has]] = np.where(right_part < 0, _NONE, self.rank(parts[i, left[has]], right_part))
        return done

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, values = len(parts), np.array(parts)
        first = self.rank(values[:-1], values[1:]).tolist()

        def rank(left: int, right: int) -> int:
            key = left << _SHIFT | right
            at = int(np.searchsorted(self.keys, key))
            return int(self.ranks[at]) if self.keys[at] == key else _NONE

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r < _NONE]
        heapq.heapify(heap)
        while heap:
            least, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or parts[i] != left or parts[j] != right:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = least & _MASK, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank(parts[a], parts[b])) < _NONE:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def encode(self, texts: pa.Array) -> Ragged:
        """Ids of each text; a null text has none. Special tokens keep their ids."""
        texts = texts.fill_null("")
        marked = np.zeros(len(texts), bool)
        for t in self.special:
            marked |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        if not marked.any():
            done = [self._encode_slice(part) for part in slices(texts)]
            return Ragged(np.concatenate([np.zeros(0, np.int32), *(d.values for d in done)]), np.concatenate([np.zeros(0, np.int64), *(d.lengths for d in done)]))
        # each text between special tokens is encoded alone; a special token is a row of one id
        parts, at, sizes = [], [], []
        for text, cut in zip(texts.to_pylist(), marked.tolist()):
            here = self._special.split(text) if cut else [text]
            for i, part in enumerate(here):
                at.append(-1 - self.special[part] if i % 2 else len(parts))
                if i % 2 == 0:
                    parts.append(part)
            sizes.append(len(here))
        done = [self._encode_slice(part) for part in slices(pa.array(parts, pa.string()))]
        values = np.concatenate([*(d.values for d in done), np.arange(len(self.token), dtype=np.int32)])
        lengths = np.concatenate([*(d.lengths for d in done), np.ones(len(self.token), np.int64)])
        rows = np.array(at, np.int64)
        return Ragged(values, lengths).take(np.where(rows < 0, len(parts) - 1 - rows, rows)).groups(np.array(sizes, np.int64))

    def _encode_slice(self, texts: pa.Array) -> Ragged:
        raw = raw_bytes(texts)
        if (raw.values >= 128).any():  # else the texts are in NFC
            raw = raw_bytes(pa.array([t if unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string()))
        words, number = split_words(raw)
        del raw
        if not len(words):
            return Ragged(np.zeros(0, np.int32), np.zeros(len(texts), np.int64))
        coded = words.dictionary_encode()
        del words
        # the pieces of each distinct word, and the ids of each distinct piece
        pieces, sizes = _pieces(coded.dictionary)
        pieces = pieces.dictionary_encode()
        of_word = self.merge(pieces.dictionary).take(pieces.indices.to_numpy()).groups(sizes)
        return of_word.take(coded.indices.to_numpy()).groups(number)

    def decode(self, ids: Ragged) -> pa.Array:
        """The tokens of each row, joined by one space, as a vocabulary file without a decoder asks."""
        spelled = self._spelled.take(ids.values).groups(ids.lengths)
        ends = spelled.ends - np.minimum(np.cumsum(ids.lengths > 0), np.arange(1, len(ids.lengths) + 1))
        keep = np.ones(len(spelled.values), bool)
        keep[spelled.ends[spelled.lengths > 0] - 1] = False  # the space behind the last token
        return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(spelled.values[keep]))


def _pieces(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-case pieces of words, and how many each word has.

    A piece is a run of letters, one number, a run of other characters, or an
    apostrophe at the start of a piece with one of ``ENDINGS``.
    """
    lower = "\n".join(words.to_pylist()).replace("Σ", "σ").lower() + "\n"
    points = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
    late = np.flatnonzero(points >= NEW_CAPITALS[0][0])
    if len(late):
        points = points.copy()
        for low, high, small in NEW_CAPITALS:
            hit = late[(points[late] >= low) & (points[late] <= high)]
            points[hit] += np.uint32((small - low) % (1 << 32))
        lower = points.tobytes().decode("utf-32-le")
    kind = _classes()[points]
    kind[points == 10] = 0
    start = (kind != np.concatenate([[0], kind[:-1]])) | (kind == 2)
    marks = np.flatnonzero((points == ord("'")) & start)
    for ending in ENDINGS:
        at = marks[marks + len(ending) < len(points)]
        for i, c in enumerate(ending, 1):
            at = at[points[at + i] == ord(c)]
        start[at + 1] = False
        start[at + 1 + len(ending)] = True
    start &= kind > 0
    size = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
    size[kind == 0] = 0
    place = np.cumsum(size, dtype=np.int32) - size
    begins = np.flatnonzero(start)
    data = np.frombuffer(lower.encode(), np.uint8)
    offsets = np.append(place[begins], place[-1]).astype(np.int32)
    number = np.diff(np.searchsorted(begins, np.flatnonzero(points == 10)), prepend=0)
    return pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data[data != 10])), number


def worker_bpe(path: str) -> WordBpe:
    """The coder of a Python worker for one vocabulary."""
    return worker_object(("bpe", path), lambda: WordBpe(path))


def _lists(ids: Ragged) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ids.ends]), pa.int32()), pa.array(ids.values, pa.int32()))


def bpe_encode(text: Column | str, vocab_path: str) -> Column:
    """Token ids (array<int>) of each text; a null text gives an empty array.

    An empty text, or one of white space alone, gives an empty array too.
    """

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _lists(worker_bpe(vocab_path).encode(texts))

    return encode(text)


def bpe_decode(ids: Column | str, vocab_path: str) -> Column:
    """The text that each array of ids spells; null gives an empty text.

    Tokens are joined by one space, as a vocabulary file without a decoder asks.
    """

    @F.arrow_udf("string")
    def decode(arrays: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return worker_bpe(vocab_path).decode(Ragged(pc.list_flatten(arrays).to_numpy(zero_copy_only=False), lengths))

    return decode(ids)


def bpe_round_trip(df: DataFrame, vocab_path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded_text") -> DataFrame:
    """Add the ids of each text and the text that these ids decode to, in one pass.

    All columns stay, except that columns already named ``ids`` or ``decoded``
    are replaced. Null texts count as empty; repeated rows are encoded alike.
    """

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        bpe = worker_bpe(vocab_path)
        chunks = []
        for part in slices(texts):
            got = bpe.encode(part)
            chunks.append(pa.StructArray.from_arrays([_lists(got), bpe.decode(got)], names=["ids", "decoded"]))
        release_memory()
        return pa.concat_arrays(chunks) if chunks else pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())]))

    got = F.col("__bpe")
    return df.withColumn("__bpe", both(F.col(text).cast("string"))).withColumns({ids: got["ids"], decoded: got["decoded"]}).drop("__bpe")


def bpe_digest(df: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 digests of ids and decoded text of ``documents``."""
    out = bpe_round_trip(df.select("doc_id", "text"), vocab_path)
    return out.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )
