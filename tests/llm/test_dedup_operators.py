"""SimHash, passage removal, components, sharding, search, media and licences against brute force."""

import hashlib
import random
import zlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quorumkit.llm import ann, chroma, common, components, hilbert, licenses, lookup, resemblance, simhash, suffix_dedup


def find(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def brute_components(codes, near):
    parent = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if near(codes[i], codes[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(len(codes))]


def reference_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def reference_shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_fingerprints_and_components(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeÉñ") for _ in range(4))
    texts = ["", None, "One", "one two\tTHREE", " ".join(word() for _ in range(30_000))]
    for _ in range(6):
        base = [word() for _ in range(300)]
        for _ in range(7):
            copy = base[:]
            copy[rng.randrange(300)] = word()
            texts.append(" ".join(copy))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[-1]), (3, texts[3])]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string").withColumn("code", F.lit(1)), 4, 4).collect()
    assert len(got) == len(rows)
    prints = [reference_print(t, 4) for t in texts]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    for r in got:
        if r["doc_id"] is not None:
            assert int(r["fingerprint"], 16) == prints[r["doc_id"]] and r["component_id"] == roots[r["doc_id"]]
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_the_components_of_every_bucket(seed):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(15):
        centre = int(rng.integers(0, 1 << 62))
        for _ in range(int(rng.integers(1, 80))):
            x = centre
            for _ in range(int(rng.integers(0, 9))):
                x ^= 1 << int(rng.integers(0, 64 if seed % 2 else 12))
            out.add(x)
    codes = np.array(sorted(out), np.uint64)
    bucket = rng.integers(0, 1 + seed % 3, len(codes))
    a, b = simhash.link_buckets(bucket, codes, 4)
    at = {int(c): i for i, c in enumerate(codes)}
    parent = list(range(len(codes)))
    for x, y in zip(a, b):
        i, j = find(parent, at[int(x)]), find(parent, at[int(y)])
        parent[max(i, j)] = min(i, j)
    expected = brute_components(list(zip(codes.tolist(), bucket.tolist())), lambda p, q: p[1] == q[1] and (p[0] ^ q[0]).bit_count() <= 4)
    assert [find(parent, i) for i in range(len(codes))] == expected


def test_hot_buckets_are_cut_into_chunk_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 20)
    rng = np.random.default_rng(9)
    codes = sorted({int(rng.integers(0, 1 << 20)) << 3 for _ in range(60)} | {(1 << 40) ^ (1 << int(i)) ^ (1 << int(j)) for i in range(40) for j in (i, 41 + i % 20)})
    found = {r["code"]: r["root"] for r in simhash.code_components(spark.createDataFrame([(c,) for c in codes], "code long"), 4).collect()}
    expected = brute_components(codes, lambda a, b: (a ^ b).bit_count() <= 4)
    mine = [found.get(c, c) for c in codes]
    assert len({(a, b) for a, b in zip(mine, expected)}) == len(set(mine)) == len(set(expected))


def test_block_masks_meet_the_pigeonhole():
    rng = random.Random(3)
    for n in (10, 10**6, 10**9):
        masks = simhash.block_masks(n, 4)
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            assert any(x & m == 0 for m in masks)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (None, 3), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(71)} == {0} and {got[100 + i] for i in range(30)} == {100} and got[301] == 300 and 200 not in got
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"), (None, "other words here now and then", "z"), (4, None, "z"), (5, "", "w")]
    got = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, code string"))
    assert got.columns == ["doc_id", "text", "code"]
    assert sorted((r["doc_id"] or -1, r["code"]) for r in got.collect()) == [(-1, "z"), (1, "y"), (4, "z")]


def test_rows_are_found_by_their_numbers(spark):
    numbered = common.materialize(spark.range(0, 1000, numPartitions=7).select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("x"), F.lit("t").alias("number")))
    every = {r["x"]: r["row"] for r in numbered.collect()}
    for some in ([], [3], range(0, 1000, 3), range(1000)):
        wanted = spark.createDataFrame([(every[i],) for i in some] + [(every[i],) for i in some[:5]] + [(None,), (-1,), (1 << 50,)], "w long")
        got = lookup.rows_in(numbered, wanted, "row")
        assert got.columns == numbered.columns and sorted(r["x"] for r in got.collect()) == sorted(some)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    odd = spark.createDataFrame([(None, 1), (5, 2), (5, 3), (-7, 4), ((3 << 33) + 5, 5)], "row long, x int")
    assert sorted(r["x"] for r in lookup.rows_in(odd, spark.createDataFrame([(5,), (-7,), (None,)], "row long"), "row").collect()) == [2, 3, 4]
    assert lookup.rows_in(odd.where("false"), odd.select("row"), "row").count() == 0


@pytest.mark.parametrize("chunk", [1_000_000, 500])
def test_every_pair_of_similar_shingles_is_in_one_group(spark, monkeypatch, chunk):
    monkeypatch.setattr(resemblance, "CHUNK_SHINGLES", chunk)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgÉñ") for _ in range(5))
    texts = ["", None, "One", "one two", " ".join(word() for _ in range(20_000))]
    for edits in range(12):  # a copy of n edits has a similarity of about (116 - 5n) / (116 + 5n)
        base = [word() for _ in range(120)]
        for _ in range(6):
            copy = base[:]
            for at in rng.sample(range(0, 120, 6), edits):
                copy[at] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(120)]  # neighbours are alike, the ends are not
    for at in range(0, 48, 2):
        chain[at] = word()
        texts.append(" ".join(chain))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, texts[7], "x"), (None, texts[7], "x")]
    got = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, bands string"))
    assert got.columns == ["doc_id", "text", "bands"]
    things = [(reference_print(t, 5), reference_shingles(t, 5)) for t in texts]
    near = lambda a, b: (a[0] ^ b[0]).bit_count() <= 4 or 10 * len(a[1] & b[1]) >= 8 * len(a[1] | b[1]) > 0
    roots = brute_components(things, near)
    assert len({i for i, r in enumerate(roots) if any(near(things[i], things[j]) and (things[i][0] ^ things[j][0]).bit_count() > 4 for j in range(i))}) > 10
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(set(roots))


def test_shingles_of_a_bucket_are_compared_once_linked():
    sets = [[1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [10, 11], [2, 3, 4, 5, 6], [10, 11]]
    sizes, flat = np.array([len(x) for x in sets]), np.array(sum(sets, []))
    links = resemblance.link_sets(np.arange(5), sizes, flat, 0.8, np.zeros(5, int))
    assert len(links) == 3 and {frozenset(x) for x in links} == {frozenset((0, 1)), frozenset((1, 3)), frozenset((2, 4))}
    assert resemblance.link_sets(np.array([7, 7, 8, 7, 8]), sizes, flat, 0.8, np.zeros(5, int)) == []


def brute_removal(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = b"\x01" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(bool(g and (not i or not gone[i - 1])) for i, g in enumerate(gone))
        yield len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def brute_rest(texts, span):
    """The text that stays of each; characters that are cut in part go as a whole."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = b"\x01" * span
        yield bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")


@pytest.mark.parametrize("stretch", [1 << 18, 700])
def test_passage_removal_against_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rng = random.Random(stretch)
    make = lambda n: "".join(rng.choice("abcdefghij klmnop é") for _ in range(n))
    passages = [make(rng.randint(380, 900)) for _ in range(5)]
    texts = []
    for _ in range(40):
        t = make(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            t += rng.choice(passages)[rng.randint(0, 30) :] + make(rng.randint(0, 200))
        texts.append(t)
    for b in texts[:8]:
        for _ in range(4):
            c = list(b)
            for _ in range(rng.randint(1, 3)):
                if c:
                    c[rng.randrange(len(c))] = "#"
            texts.append("".join(c))
    texts += [None, "", "a" * 1500, "ab" * 700, "heer " * 300, make(399), passages[0][:400], passages[0][:401], "x" + passages[0][:400], texts[3], make(3000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, passages[1] * 2), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for span in (400, 200, 90):
        expected = Counter((r[0], *b) for r, b in zip(rows, brute_removal([r[1] for r in rows], span)))
        assert Counter(map(tuple, suffix_dedup.repeats_digest(df, span).select(columns).collect())) == expected
    clash = df.withColumns({c: F.lit(f"own {c}") for c in ("k1", "k2", "data", "marks", "again", "cut", "row", "pos")})
    out = suffix_dedup.remove_repeats(clash, 400)
    assert out.columns[2:-4] == clash.drop("kept").columns[2:] and {tuple(r) for r in out.select(*out.columns[2:-4]).distinct().collect()} == {tuple(f"own {c}" for c in out.columns[2:-4])}


def test_passage_removal_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.repeats_digest(empty).count() == 0
    one = spark.createDataFrame([(1, "short")], "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.repeats_digest(one).collect()] == [0]


def test_repeats_across_the_ends_of_the_bucket_around_zero(spark):
    for lead in range(4):
        values = [-100] * lead + [v for v in (-7, -5, -3, -2, 2, 4, 6, 8) for _ in range(2)] + [100] * 3
        rows = [(v, 0, i, 0, i) for i, v in enumerate(values)]
        marks, _ = suffix_dedup._level(spark.createDataFrame(rows, "t1 long, t2 long, k1 long, k2 int, pos int"), 3, 400)
        n = Counter(values)
        assert {r["pos"] for r in marks.collect()} == {i for i, v in enumerate(values) if n[v] > 1}


def test_multikey_order():
    rng = np.random.default_rng(5)
    tokens = [rng.integers(0, 4, 9000).astype(np.uint64), rng.integers(0, 9, 9000).astype(np.uint64), rng.integers(0, 1 << 60, 9000).astype(np.uint64)]
    order = suffix_dedup.multikey_quicksort(tokens)
    assert sorted(order.tolist()) == list(range(9000))
    assert (np.lexsort(tokens[::-1]).shape == order.shape) and [tuple(int(t[i]) for t in tokens) for i in order] == sorted(zip(*(t.tolist() for t in tokens)))


def test_hilbert_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        points = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(side)] * n, indexing="ij")], 1)
        at = hilbert.hilbert_index(points, bits)
        assert sorted(at.tolist()) == list(range(side**n))
        path = points[np.argsort(at)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards_are_even_and_prune(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")
    df = df.unionByName(spark.createDataFrame([(None, None, None, None), (3, "x", "en", None), (3, "x", "en", None)], df.schema))
    rows = hilbert.hilbert_shards(df).collect()
    n = Counter(r["shard"] for r in rows)
    assert len(rows) == df.count() and set(n) == set(range(16)) and max(n.values()) - min(n.values()) <= 1
    for s in n:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n[s]))
    few = hilbert.hilbert_shards(df.limit(5)).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(i, 0) for i in range(5)]
    assert hilbert.hilbert_shards(df.limit(0)).count() == 0
    manifest = hilbert.shard_manifest(hilbert.hilbert_shards(df), ["size"])
    kept = {r["shard"] for r in hilbert.prune_shards(manifest, "size", 50_000, 10**9).collect()}
    assert {r["shard"] for r in rows if r["size"] >= 50_000} <= kept


def test_shards_against_a_plain_sort(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")
    copies = [(9000 + i, f"copy {i % 3}" if i % 5 else "", ("en", "de", None)[i % 3], f"s{i % 7}") for i in range(150)]
    df = df.unionByName(spark.createDataFrame([*copies, (None, None, None, None), (7, "long " * 60_000, "en", "a")], df.schema))
    plain = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), hilbert.quantise_label(F.col("lang")).alias("l"), hilbert.quantise_label(F.col("source")).alias("s"))
    plain = plain.select("*", F.xxhash64(F.col("text").cast("binary")).alias("h"), hilbert.quantise_number(F.octet_length("text") + 1).alias("n")).collect()
    least = {}
    for r in plain:
        least[r["text"]] = min(least.get(r["text"], (r["l"], r["s"])), (r["l"], r["s"]))
    curve = hilbert.hilbert_index(np.array([(*least[r["text"]], r["n"]) for r in plain]), hilbert.BITS)
    of = [(int(c), r["h"], zlib.crc32(r["text"].encode()), len(r["text"].encode()) + 1, -1 if r["doc_id"] is None else r["doc_id"]) for c, r in zip(curve, plain)]
    few, more = divmod(len(of), 16)
    expected = [(shard, slot) for shard in range(16) for slot in range(few + (shard < more))]
    got = hilbert.hilbert_shards(df).collect()
    key = lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["text_crc32"], r["size"], r["curve"])
    assert sorted((*key(r), r["shard"], r["slot"]) for r in got) == sorted((d, c, n, at, *place) for (at, _, c, n, d), place in zip(sorted(of), expected))
    shards = {}
    for r in got:
        shards.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert sum(len(v) > 1 for v in shards.values()) <= 15


def nearest_rows(unit, queries, k):
    return [np.argsort(-(unit @ unit[q]) + 9.0 * (np.arange(len(unit)) == q), kind="stable")[:k] for q in queries]


def test_recall_and_scores_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = df.toPandas().sort_values("vec_id", ignore_index=True)
    x = np.array(data["embedding"].tolist(), float)
    norm = np.linalg.norm(x, axis=1)
    asked = np.flatnonzero(data["vec_id"].to_numpy() % 50 == 0)
    truth = {(int(data["vec_id"][q]), int(data["vec_id"][v])) for q, best in zip(asked, nearest_rows(x / norm[:, None], asked, 5)) for v in best}
    got = ann.nearest(df, 5, 50).collect()
    place = {v: i for i, v in enumerate(data["vec_id"])}
    assert len(truth & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * len(truth)
    for r in got:
        a, b = place[r["query_id"]], place[r["vec_id"]]
        assert r["score"] == pytest.approx(x[a] @ x[b] / (norm[a] * norm[b]), abs=1e-12)


def test_rows_that_share_a_vec_id_are_candidates_of_each_other(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.1]), (7, [0.0, 1.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(50, 1, 50), (50, 1, 50), (50, 2, 7), (50, 2, 7)]


def test_multi_index_recall_and_rules(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[650:] = x[0]  # many equal vectors: ties by id
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(700, None, "c"), (750, [0.0] * 16, "c"), (751, [float("nan")] * 16, "c"), (None, x[1].tolist(), "c"), (800, [None] * 16, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.nearest(df, 5, 50).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert {q for q, _ in found} == set(range(0, 700, 50))
    truth = {(q, int(v)) for q, best in zip(range(0, 700, 50), nearest_rows(np.round(unit, 12), range(0, 700, 50), 5)) for v in best}
    assert len(found & truth) / len(truth) >= 0.9
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 0), key=lambda r: r["rank"])] == [650, 651, 652, 653, 654]
    few = ann.nearest(df.where("vec_id IN (0, 1, 2)"), 5, 50)
    assert few.count() == 2
    assert ann.nearest(df.limit(0)).count() == 0


def test_substring_probing_is_complete():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 256, (300, 8), dtype=np.uint8)
    codes[:50] = codes[0] ^ (1 << rng.integers(0, 8, (50, 8))).astype(np.uint8) * (rng.random((50, 8)) < 0.4)
    index = ann.SubstringIndex(codes)
    for radius in (0, 3, 9, 20, 33, 64):
        expected = np.flatnonzero(np.bitwise_count(codes ^ codes[0]).sum(1) <= radius)
        assert index.within(codes[0], radius).tolist() == expected.tolist()


def test_chroma_alignment(spark):
    rng = np.random.default_rng(10)
    song = rng.integers(0, 256, 64 * 200, dtype=np.uint8).tobytes()
    rows = [(0, song), (1, song), (2, song[64 * 40 :]), (3, rng.integers(0, 256, 9000, dtype=np.uint8).tobytes()), (4, b""), (5, None), (None, song)]
    got = {(r["query_id"], r["match_id"]): r for r in chroma.search_recordings(spark.createDataFrame(rows, "rec_id long, media binary").withColumn("print", F.lit(1)), 5, 50).collect()}
    assert got[0, 0]["class_size"] == 2 and got[0, 0]["bit_error"] == 0
    assert got[0, 2]["frame_offset"] == -40 and got[0, 2]["bit_error"] < 0.01
    assert all(r["bit_error"] <= chroma.MAX_ERROR for r in got.values())
    assert chroma.search_recordings(spark.createDataFrame([], "rec_id long, media binary")).count() == 0


def test_short_recordings_are_found(spark):
    rng = np.random.default_rng(12)
    make = lambda n: rng.integers(32, 123, n, dtype=np.uint8).tobytes()
    rows, sizes = [], [2, 40, 100, 300, 449, 700, 1215, 1216, 1500, 1663, 1664, 5000]
    for i, n in enumerate(sizes):
        song = make(n)
        rows += [(50 * i, song), (50 * i + 1, song), (50 * i + 2, song[: n // 2] + b"#" + song[n // 2 + 1 :])]
    long = make(4000)
    rows += [(5000, long[64 * 10 : 64 * 10 + 1500]), (5001, long)]
    got = {(r["query_id"], r["rank"]): r for r in chroma.search_recordings(spark.createDataFrame(rows, "rec_id long, media binary"), 5, 50).collect()}
    for i, n in enumerate(sizes):
        assert got[50 * i, 1]["match_id"] == 50 * i and got[50 * i, 1]["frame_offset"] == 0 and got[50 * i, 1]["class_size"] >= 2
    near = {(r["query_id"], r["match_id"]) for r in got.values()}
    assert all((50 * i, 50 * i + 2) in near for i, n in enumerate(sizes) if n >= 700)
    assert (5000, 5001) in near


def test_alignment_counts_against_brute_force():
    rng = np.random.default_rng(11)
    prints = rng.integers(0, 5, 60).astype(np.uint32)
    begins = np.array([0, 25, 60])
    record = np.repeat([0, 1], [25, 35])
    place = np.concatenate([np.arange(25), np.arange(35)])
    order = np.argsort(prints, kind="stable")
    query = prints[30:50]
    got = {r: (c, o) for r, o, c, n, e in chroma.alignments(query, prints[order], record[order], place[order], begins, prints)}
    own = Counter(p - i for i, v in enumerate(query) for p, w in enumerate(prints[25:60]) if v == w)
    assert got[1] == (max(own.values()), 5) and own[5] == max(own.values())


def test_license_scan_and_inheritance(spark):
    rows = [
        (1, "a", "Released under the MIT License.", "k"),
        (2, "a/b", "Some code here\nwithout a word on that.", "k"),
        (3, "a/b/c", "# Licensed under the Apache License, Version 2.0.\nprint(1)\n" + "filler words " * 400, "k"),
        (4, "z", "nothing at all", "k"),
        (5, "a/q", None, "k"),
        (6, None, "", "k"),
        (7, "a/q", "We talk about a license in passing and of many other things besides.", "k"),
    ]
    out = {r["file_key"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "file_key long, folder string, text string, license string")).collect()}
    assert (out[1]["license"], out[1]["origin"]) == ("MIT", "own")
    assert (out[2]["license"], out[2]["origin"], out[2]["from_folder"]) == ("MIT", "inherited", "a")
    assert (out[3]["license"], out[3]["origin"]) == ("Apache-2.0", "own")
    assert out[4]["license"] is None and out[6]["license"] is None
    assert out[5]["license"] == out[7]["license"] == "MIT"
    assert licenses.scan_licenses(spark.createDataFrame([], "file_key long, folder string, text string")).count() == 0


MIT_BODY = """Copyright (c) 2024 Some Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_licence_files_of_full_texts_govern_their_folders(spark):
    texts = {}
    for i, (name, text) in enumerate(licenses.bodies()):
        texts[i] = (name, text if i % 2 else "Copyright 2023, 2024 The Authors of Something\n\n" + text)
    texts[len(texts)] = ("MIT", MIT_BODY)
    prose = "In this essay the author writes on the history of copyright and of the license of printers, and on what the public has to say of it. " * 20
    rows = [(2 * i, f"d{i}", text) for i, (_, text) in texts.items()] + [(2 * i + 1, f"d{i}/src", "plain code without any word on it") for i in texts]
    rows += [(1000, "essay", prose), (1001, "essay/x", "plain code")]
    out = {r["file_key"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "file_key long, folder string, text string")).collect()}
    for i, (name, _) in texts.items():
        assert (out[2 * i + 1]["license"], out[2 * i + 1]["origin"], out[2 * i + 1]["from_folder"]) == (name, "inherited", f"d{i}"), name
    assert out[1000]["license"] is None and out[1001]["license"] is None


def test_license_scores_against_python(spark, data):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    vocabulary = {w for _, t in licenses.TEMPLATES for w in words(t)}
    n = Counter(w for t in texts.values() for w in vocabulary & set(words(t)))
    idf = {w: np.log((1 + len(texts)) / (1 + n[w])) + 1 for w in vocabulary}
    vec = lambda t: {w: c * idf.get(w, 1.0) for w, c in Counter(words(t)).items()}
    norm = lambda v: np.sqrt(sum(x * x for x in v.values()))
    tv = [(name, vec(t)) for name, t in licenses.TEMPLATES]

    def best(t):
        v = vec(t)
        return min((-round(sum(x * y.get(w, 0) for w, x in v.items()) / (norm(v) * norm(y)), 6), name) for name, y in tv)

    expected = {}
    for i, t in texts.items():
        units = [x for x in re.split(r"\n+|(?<=[.!?])\s+", t) if re.search(licenses.SIGNALS, x.lower())]
        got = [b for b in map(best, units) if -b[0] >= licenses.HEADER_COSINE]
        if re.search(licenses.SIGNALS, t.lower()) and -best(t)[0] >= licenses.FILE_COSINE:
            got.append(best(t))
        if got:
            expected[i] = min(got)[1]
    found = {r["doc_id"]: r["license"] for r in licenses.scan_documents(df).where("origin = 'own'").collect()}
    assert found == expected
