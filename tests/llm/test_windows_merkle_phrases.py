"""Operators 11 to 13 against brute force on small fixtures."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quorumkit.llm import collocation, merkle, spans, window_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# windows --------------------------------------------------------------------


def windows_by_hand(rows, size):
    """(doc_id, n_words, n_removed, kept) of rows in document order."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen, out = set(), []
    for (i, _), w in zip(rows, words):
        gone = set()
        for a in range(len(w) - size + 1):
            s = tuple(w[a : a + size])
            if s in seen:
                gone.update(range(a, a + size))
            seen.add(s)
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def passages(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(40)]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(15, 40))) for _ in range(6)]
    return [(i, "  ".join(rng.choice(shared) if rng.random() < 0.5 else "\t".join(rng.choices(vocab, k=rng.randint(0, 30))) for _ in range(rng.randint(0, 5)))) for i in range(n)]


@pytest.mark.parametrize("size", [3, 20])
def test_windows_equal_brute_force(spark, size):
    rows = passages(size, 60) + [(100, None), (101, ""), (102, " \n "), (103, "x " * 400), (104, " ".join(["a b"] * 60))]
    frame = docs(spark, [(i, t, "en", "s", 1) for i, t in rows])
    out = window_dedup.remove_repeated_windows(frame, size).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == windows_by_hand(rows, size)
    for r in out:
        assert sum(s.end - s.start for s in r.removed_spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed_spans, r.removed_spans[1:]))


def test_windows_of_repeated_and_missing_ids(spark):
    long = " ".join(f"v{i}" for i in range(30))
    rows = [(7, long), (7, long), (None, long), (3, "short text"), (7, None), (None, None)]
    out = window_dedup.remove_repeated_windows(docs(spark, [(i, t, None, None, None) for i, t in rows]), 20).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in out) == [(-1, 0, 0), (-1, 30, 30), (3, 2, 0), (7, 0, 0), (7, 30, 0), (7, 30, 30)]


def test_windows_keep_columns_and_take_no_rows(spark):
    frame = docs(spark, [(1, "a b c d", "en", "s", 9)]).withColumnRenamed("n_chars", "n_words").withColumnRenamed("lang", "__group")
    out = window_dedup.remove_repeated_windows(frame, 2)
    assert out.columns == ["doc_id", "text", "__group", "source", "n_words", "n_removed", "removed_spans", "kept"]
    r = out.first()
    assert (r.n_words, r.text, r["__group"]) == (4, "a b c d", "en")
    assert window_dedup.remove_repeated_windows(docs(spark, []), 20).collect() == []


def test_windows_of_a_long_text_in_chunks(spark, monkeypatch):
    """One text of 9 MB that repeats its first part; words of one document in several chunks."""
    rng = np.random.default_rng(5)
    part = " ".join(rng.integers(0, 1 << 30, 600_000).astype(str))
    text = part + " " + part[: len(part) // 3] + " end"
    out = window_dedup.windows_digest(docs(spark, [(1, text, "en", "s", 1), (2, "x y", "en", "s", 1)]), 20).collect()
    kept, n = {r.doc_id: r for r in out}[1], len(text.split())
    cut = len(part[: len(part) // 3].split())  # the last of them may be part of a number
    assert kept.n_words == n and cut - 1 <= kept.n_removed <= cut


def test_window_hashes_are_polynomials():
    x = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)
    for size in (1, 2, 3, 5, 7, 20, 31):
        base = spans.WORD_BASES[0]
        slow = [sum(int(v) * pow(base, size - 1 - k, 1 << 64) for k, v in enumerate(x[i : i + size])) % (1 << 64) for i in range(50 - size + 1)]
        assert spans.window_hashes(x, size, base).tolist() == slow


def test_packed_numbers_come_back():
    for values in ([], [5], [3, 3, 9, -4, 1 << 40]):
        a = np.array(values, np.int64)
        assert spans.unpack(spans.pack(a), len(a), np.int64).tolist() == values


def test_group_column_says_what_tasks_say(spark):
    keys = np.array([0, 1, -1, 12345678901234, -(1 << 63), (1 << 63) - 1], np.int64)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long")
    rows = {r.k: r.g for r in frame.select("k", window_dedup.group_column(frame.k, 7).alias("g")).collect()}
    assert [rows[int(k)] for k in keys] == window_dedup.group_of(keys, 7).tolist()


# manifest -------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_by_hand(rows):
    def leaf(i, text, lang, source, n):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    def build(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][a : a + 16]) for a in range(0, len(levels[-1]), 16)])
        return levels

    def steps(levels, at):
        for nodes in levels[:-1]:
            low = at - at % 16
            yield nodes[low:at], nodes[at + 1 : low + 16]
            at //= 16

    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = build([leaf(*r) for r in by_source[s]])
    top = build([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, r in enumerate(by_source[s]):
            path = [*steps(trees[s], at), *steps(top, k)]
            now = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf(r[0], r[1] and re.sub("[A-Z]", lambda m: m[0].lower(), r[1]), *r[2:])
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*(x for left, right in path for x in (*left, *right)))
            out.append((r[0], leaf(*r), trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def same_manifest(spark, rows):
    frame = docs(spark, rows).withColumn("key", merkle.F.lit(1)).withColumn("pos", merkle.F.lit("x"))
    got = [tuple(r) for r in merkle.merkle_manifest(frame).collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(manifest_by_hand(rows), key=order)


def test_manifest_equals_brute_force(spark):
    """Sources of 1, 2, 16, 17, 256, 257, 300 and 600 rows, nulls everywhere, repeated rows."""
    sizes = {"one": 1, "two": 2, "é": 16, "seventeen": 17, "full": 256, "more": 257, None: 300, "": 600}
    rows = [(1000 * k + i, f"Text {i} É" if i % 3 else None, None if i % 4 == 0 else "en", s, None if i % 5 == 0 else i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(None, "Null id", "en", "two", 1), (None, None, None, None, None), rows[5], rows[5]]
    same_manifest(spark, rows)


def test_manifest_over_many_sources_and_few_rows(spark):
    same_manifest(spark, [(i, "A", "en", f"s{i % 40}", 1) for i in range(90)])
    same_manifest(spark, [(i, "A", "en", f"s{i}", 1) for i in range(20)])
    same_manifest(spark, [(1, "A b", "en", "s", 1)])
    same_manifest(spark, [(i, None, "en", None, 1) for i in range(33)])
    assert merkle.merkle_manifest(docs(spark, [])).collect() == []


# phrases --------------------------------------------------------------------


def phrases_by_hand(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    out, often = {}, {k: v for k, v in f.items() if v >= least}
    held = {(lang, p[i:j]) for (lang, p), v in often.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and often[lang, p[i:j]] == v}
    for (lang, p), a in often.items():
        if len(p) > 1 and (lang, p) not in held:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_equal_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    vocab = ["A", "b", "É", "dd", " x", "e-", "ff"]
    fixed = ["b dd É", "A A A A A A", "e- ff A b dd x", "Ff"]
    rows = [(i, rng.choice(["", None, *[". ".join(rng.choice(fixed) if rng.random() < 0.3 else " \t".join(rng.choices(vocab, k=rng.randint(0, 9))) for _ in range(5))] * 6]), rng.choice(["en", "fr", None]), "s", 1) for i in range(250)]
    rows += [rows[3]] * 3
    got = sorted(tuple(r) for r in collocation.collocations(docs(spark, rows), least=8, top=30).collect())
    assert got == phrases_by_hand(rows, 8, 30)
    assert len(got) > 40


def test_collocations_over_many_slices_and_partitions(spark, monkeypatch):
    """Sorted streams in many partitions, so that beginnings stand in earlier ones; long texts in several slices."""
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(12)]
    rows = [(i, "\n".join(" ".join(rng.choices(vocab, weights=range(1, 13), k=12)) for _ in range(40)), "en", "s", 1) for i in range(30)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    monkeypatch.setattr(collocation, "SLICE_BYTES", 500)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(tuple(r) for r in collocation.collocations(docs(spark, rows), least=10, top=5000).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == phrases_by_hand(rows, 10, 5000)


def test_collocations_of_nothing(spark):
    assert collocation.collocations(docs(spark, [])).collect() == []
    assert collocation.collocations(docs(spark, [(1, None, None, None, None), (2, " . ", "en", None, None)])).collect() == []


def test_products_beyond_64_bits(spark):
    """The score's product, of a pair whose counts multiply to more than 64 bits, as the operator makes it."""
    a, n, left, right = 4_000_000_000_000, 20_000_000_000_001, 5_000_000_000_003, 6_000_000_000_007
    counts = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert counts.select(collocation.exact_score()).first()[0] == 1000 * a * n // (left * right)


# earlier operators ----------------------------------------------------------


def test_buckets_link_as_all_pairs_would():
    """Spanning links of a bucket against all pairs, for random roots, chunks and similarities."""
    from quorumkit.llm.resemblance import link_sets

    def classes(n, edges):
        own = list(range(n))
        for a, b in edges:
            x, y = own[a], own[b]
            own = [x if c == y else c for c in own]
        return [own.index(c) for c in own]

    for seed in range(200):
        r = np.random.default_rng(seed)
        n = int(r.integers(1, 30))
        rows = [r.permutation(np.unique(r.integers(-7, 7, r.integers(1, 12)))) for _ in range(n)]
        roots, chunk, similarity = r.integers(0, n, n), r.integers(0, r.integers(1, 3), n), [0.5, 0.8][seed % 2]
        got = link_sets(roots, np.array([len(x) for x in rows]), np.concatenate(rows), similarity, chunk)
        crossed = len(set(chunk)) > 1
        pairs = [(i, j) for i in range(n) for j in range(i)]
        near = {(i, j) for i, j in pairs if len(np.intersect1d(rows[i], rows[j])) >= similarity * len(np.union1d(rows[i], rows[j])) - 1e-9 and (not crossed or chunk[i] != chunk[j])}
        same = [(i, j) for i, j in pairs if roots[i] == roots[j]]
        assert classes(n, [*same, *got]) == classes(n, [*same, *near])
        assert {(max(e), min(e)) for e in got} <= near


def test_shared_boilerplate_is_never_compared():
    """10,000 rows that share 140 of 200 shingles: no links, in seconds."""
    import time

    from quorumkit.llm.resemblance import link_sets

    r = np.random.default_rng(1)
    shared, n = r.integers(-(1 << 62), 1 << 62, 140), 10_000
    flat = np.concatenate([np.concatenate([shared, r.integers(-(1 << 62), 1 << 62, 60)]) for _ in range(n)])
    began = time.time()
    assert link_sets(np.arange(n), np.full(n, 200), flat, 0.8, np.zeros(n, int)) == []
    assert time.time() - began < 30


def test_nearest_of_tiny_and_huge_vectors(spark):
    """Components of any finite size take part, and scores are those of the directions."""
    from quorumkit.llm import ann

    r = np.random.default_rng(2)
    base = r.normal(size=(40, 8))
    rows = [(i, (base[i] * scale).tolist()) for i, scale in zip(range(40), [1.0, 1e200, 1e-200, 1e-160, 5e-310, 1e300] * 7)]
    rows[0] = (0, base[1].tolist())
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in ann.nearest(frame, 5, 50).orderBy("rank").collect()]
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    cosine = unit @ unit[1]
    cosine[0] = -2
    assert [g[2] for g in got] == np.argsort(-cosine)[:5].tolist() and got[0][2] == 1 and abs(got[0][3] - 1) < 1e-12
    assert np.allclose([g[3] for g in got], np.sort(cosine)[::-1][:5], atol=1e-6)


def test_one_id_with_two_recordings_keeps_both(spark):
    """Classes are told apart by their fingerprints, not by their names."""
    from quorumkit.llm import chroma

    r = np.random.default_rng(3)
    a, b = (r.integers(0, 255, 6000).astype(np.uint8).tobytes() for _ in range(2))
    apart = chroma.search_recordings(spark.createDataFrame([(50, bytearray(a)), (100, bytearray(b)), (5, bytearray(a)), (6, bytearray(b))], "rec_id long, media binary"), 5, 50)
    shared = chroma.search_recordings(spark.createDataFrame([(50, bytearray(a)), (100, bytearray(b)), (5, bytearray(a)), (5, bytearray(b))], "rec_id long, media binary"), 5, 50)
    assert {(x.query_id, x.match_id) for x in apart.where("bit_error = 0").collect()} == {(50, 5), (100, 6)}
    assert {(x.query_id, x.match_id) for x in shared.where("bit_error = 0").collect()} == {(50, 5), (100, 5)}
