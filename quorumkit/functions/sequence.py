"""Column functions over nucleotide and protein texts.

What looks at single characters or windows of them runs in Arrow batches on
arrays of code points, one text at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-12
#: Fixed value: the standard genetic code, codons in TCAG order.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _count(s: Column, letter: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(letter), F.lit("")))


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def gc_content(s: Column) -> Column:
    s = F.upper(s)
    return _ratio(_count(s, "G") + _count(s, "C"), F.length(s))


def skew(s: Column, x: str, y: str) -> Column:
    """(x - y) / (x + y) of two letters' counts."""
    s = F.upper(s)
    return (_count(s, x) - _count(s, y)) / (_count(s, x) + _count(s, y) + F.lit(TINY))


def _points(text: str) -> np.ndarray:
    """Code points of one text."""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _per_text(s: Column, kind: str, one: Callable[[np.ndarray], object]) -> Column:
    """``one`` of the code points of each text, in Arrow batches; null stays null."""

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one(_points(t)) for t in texts.to_pylist()], from_ddl(kind))

    return run(s)


def from_ddl(kind: str) -> pa.DataType:
    return {"double": pa.float64(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}[kind]


def _shares(points: np.ndarray) -> np.ndarray:
    """Share of each distinct character."""
    return np.unique(points, return_counts=True)[1] / max(1, len(points))


def _shannon(points: np.ndarray) -> float:
    p = _shares(points)
    return float(-(p * np.log2(p + TINY)).sum())


def _renyi2(points: np.ndarray) -> float:
    return float(-np.log2((_shares(points) ** 2).sum() + TINY))


def _least(points: np.ndarray) -> float | None:
    return float(-np.log2(_shares(points).max() + TINY)) if len(points) else None


def shannon_entropy(s: Column) -> Column:
    return _per_text(s, "double", _shannon)


def renyi2_entropy(s: Column) -> Column:
    return _per_text(s, "double", _renyi2)


def min_entropy(s: Column) -> Column:
    return _per_text(s, "double", _least)


def _kmer_numbers(points: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of k characters; equal runs have equal numbers."""
    distinct, number = np.unique(points, return_inverse=True)
    out = number[: max(0, len(points) - k + 1)].astype(np.int64)
    for i in range(1, k):
        out = out * len(distinct) + number[i : len(out) + i]
        if i < k - 1 and len(out) and int(out.max()) > (1 << 62) // (len(distinct) + 1):
            out = np.unique(out, return_inverse=True)[1]
    return out


def _complexity(points: np.ndarray, k: int) -> float:
    most = min(4**k, len(points) - k + 1)
    return len(np.unique(_kmer_numbers(points, k))) / most if most > 0 else 0.0


def _repeats(points: np.ndarray, k: int, least: int) -> float:
    if len(points) < k:
        return 0.0
    runs = np.sort(np.lib.stride_tricks.sliding_window_view(points, k), axis=1)
    return float(((runs[:, 1:] != runs[:, :-1]).sum(1) + 1 < least).mean())


def _dust(points: np.ndarray) -> float:
    if not len(points):
        return 0.0
    a, b, c = points[:-2], points[1:-1], points[2:]
    equal = (a == b).astype(int) + (b == c) + (a == c)  # none, one or all three
    return float(np.array([0, 2, 0, 6])[equal].sum() / len(points))


def windows(s: Column, k: int) -> Column:
    """All substrings of length k, in order; empty for shorter texts."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [t[i : i + k] for i in range(len(t) - k + 1)] for t in texts.to_pylist()], pa.list_(pa.string()))

    return run(s)


def linguistic_complexity(s: Column, k: int = 3) -> Column:
    """Distinct k-mers over the most that there could be; 0 for shorter and null texts."""
    return F.coalesce(_per_text(s, "double", lambda p: _complexity(p, k)), F.lit(0.0))


def repeat_fraction(s: Column, k: int = 10, least: int = 5) -> Column:
    """Share of windows of k characters with fewer than ``least`` distinct ones."""
    return F.coalesce(_per_text(s, "double", lambda p: _repeats(p, k, least)), F.lit(0.0))


def dust_score(s: Column) -> Column:
    """Sum over 3-letter windows of v(v - 1) for each letter's count v there, over the length."""
    return F.coalesce(_per_text(s, "double", _dust), F.lit(0.0))


def text_statistics(s: Column, qual: Column) -> Column:
    """All scalar features that look at single characters, in one pass over each text."""
    fields = ("shannon", "renyi2", "min_entropy", "ling_complexity", "repeat_frac", "dust")

    @F.arrow_udf("struct<" + ", ".join(f"{f}: double" for f in (*fields, "mean_qual")) + ">")
    def run(texts: pa.Array, quals: pa.Array) -> pa.Array:
        columns: list[list[float | None]] = [[] for _ in range(7)]
        for t, q in zip(texts.to_pylist(), quals.to_pylist()):
            p = None if t is None else _points(t)
            row = [None] * 3 + [0.0] * 3 if p is None else [_shannon(p), _renyi2(p), _least(p), _complexity(p, 3), _repeats(p, 10, 5), _dust(p)]
            for column, value in zip(columns, [*row, _mean_quality(_points(q)) if q else None]):
                column.append(value)
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], names=[*fields, "mean_qual"])

    return run(s, qual)


def _mean_quality(points: np.ndarray) -> float | None:
    return float(points.mean() - 33) if len(points) else None


def mean_quality(q: Column) -> Column:
    """Mean Phred score of a quality text with offset 33."""
    return _per_text(q, "double", _mean_quality)


def kmer_vocabulary(k: int) -> list[str]:
    return ["".join(p) for p in product("ACGT", repeat=k)]


def kmer_counts(s: Column, k: int) -> Column:
    """How often each k-mer over ACGT occurs (in lexical order); others are left out. Null counts as empty."""
    code = np.full(256, 4, np.int64)
    for i, c in enumerate("ACGT"):
        code[[ord(c), ord(c.lower())]] = i

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            base = code[np.frombuffer((t or "").encode("ascii", "replace"), np.uint8)]
            n = max(0, len(base) - k + 1)
            number, good = np.zeros(n, np.int64), np.ones(n, bool)
            for i in range(k):
                number = number * 4 + base[i : n + i]
                good &= base[i : n + i] < 4
            out.append(np.bincount(number[good], minlength=4**k).astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return run(s)


def valid_kmers(s: Column, k: int) -> Column:
    """k-mers over ACGT only; others are left out and not counted."""
    return F.filter(windows(F.upper(s), k), lambda x: x.rlike("^[ACGT]+$"))


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))


def translate(s: Column, unknown: str = "X") -> Column:
    """Protein text of whole codons; stops are '*', codons with other letters ``unknown``.

    A codon's place in the code table comes from the places of its bases in TCAG.
    """
    place = np.full(256, 64, np.int64)
    for i, letters in enumerate(("TtUu", "Cc", "Aa", "Gg")):
        place[[ord(c) for c in letters]] = i
    table = np.append(np.frombuffer(GENETIC_CODE.encode(), np.uint8), np.uint8(ord(unknown)))

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is None:
                out.append(None)
                continue
            base = place[np.frombuffer(t.encode("ascii", "replace"), np.uint8)]
            n = len(base) // 3
            number = np.minimum(base[0 : 3 * n : 3] * 16 + base[1 : 3 * n : 3] * 4 + base[2 : 3 * n : 3], 64)
            out.append(table[number].tobytes().decode("ascii"))
        return pa.array(out, pa.string())

    return run(s)


def parts(s: Column, percent: Column | float) -> Column:
    """Consecutive parts of int(length * percent / 100) characters; that being 0 gives the whole."""
    step = F.floor(F.length(s) * percent / 100).cast("int")
    step = F.when(step > 0, step).otherwise(F.greatest(F.length(s), F.lit(1)))
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.length(s) - 1, F.lit(0)), step), lambda i: F.substr(s, i + 1, step))).otherwise(F.array().cast("array<string>"))


def mutate(s: Column, key: Column, rate: float, seed: int) -> Column:
    """Substitute letters at a rate, never by themselves; a rate of 1 changes exactly one position.

    A counter-based generator: number k of a text is MD5 of "key/seed/k". Its
    first 32 bits give the gap to the next place that changes (geometric, so
    letters between two such places cost nothing), the next 32 the new base among
    those that differ. Any task gives the same text. A null key counts as empty.
    """

    @F.arrow_udf("string")
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        out = []
        for text, key in zip(texts.to_pylist(), keys.to_pylist()):
            if not text or rate <= 0:
                out.append(text)
                continue
            letters, at, k = list(text), -1, 0
            while True:
                draw = hashlib.md5(f"{key or ''}/{seed}/{k}".encode()).hexdigest()
                first, second = int(draw[:8], 16), int(draw[8:16], 16)
                at = first % len(letters) if rate >= 1 else at + 1 + math.floor(math.log((first + 0.5) / 4294967296) / math.log(1 - rate))
                if at >= len(letters):
                    break
                others = [b for b in "ACGT" if b != letters[at].upper()]
                letters[at] = others[second % len(others)]
                k += 1
                if rate >= 1:
                    break
            out.append("".join(letters))
        return pa.array(out, pa.string())

    return run(s, key.cast("string"))
