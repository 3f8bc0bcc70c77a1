"""BPE, packing, toxicity and quality against libraries, bounds and held-out rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quorumkit.llm import bpe, packing, quality, ragged, toxicity
from quorumkit.llm.logit import fit_logistic

VOCAB = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a <|endoftext|>b<|startoftext|> ΑΣ ΟΔΟΣ İ été 日本 😀 don't 'S 12³ ½", "x" * 500, "!?" * 300, "<|ENDOFTEXT|>", "a\x1cb\x85c d", "Ⅷ ²  __a_b", "é ﻿", "ab\x00c", "It's WE'LL i'd'", "a,b. c.", "é" * 200 + "!" * 100]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, extra string")


def library():
    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(spark, data):
    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()] + ODD
    df = docs(spark, [*((i, t, "x") for i, t in enumerate(texts)), (None, None, None), (0, texts[0], "x")])
    t = library()
    got = [(r["text"], r["token_ids"], r["decoded_text"]) for r in bpe.bpe_round_trip(df, VOCAB).collect()]
    assert len(got) == len(texts) + 2
    for text, ids, back in got:
        expected = t.encode(text or "", add_special_tokens=False).ids
        assert ids == expected and back == t.decode(expected, skip_special_tokens=False)
    digest = {r["doc_id"]: r for r in bpe.bpe_digest(df, VOCAB).collect()}
    ids = t.encode(texts[3], add_special_tokens=False).ids
    assert digest[3]["n_tokens"] == len(ids) and digest[3]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.bpe_round_trip(df.limit(0), VOCAB).count() == 0


def test_bpe_separate_directions(spark):
    df = docs(spark, [(1, "Hello, world!", None), (2, None, None)])
    ids = df.select("doc_id", bpe.bpe_encode("text", VOCAB).alias("ids"))
    assert {r["doc_id"]: r["t"] for r in ids.select("doc_id", bpe.bpe_decode("ids", VOCAB).alias("t")).collect()} == {1: "hello</w> ,</w> world</w> !</w>", 2: ""}


def test_long_words_merge_as_short_ones():
    coder = bpe.WordBpe(VOCAB)
    rng = random.Random(2)
    words = ["".join(rng.choice("theringaton") for _ in range(rng.randint(2, bpe.LONG_WORD))) for _ in range(200)]
    got = coder.merge(pa.array(words))
    for word, ids in zip(words, np.split(got.values, got.ends[:-1])):
        parts = coder._first[list(word.encode())]
        parts[-1] = coder._last[word.encode()[-1]]
        assert coder._merge_long(parts.tolist()) == ids.tolist()


def encoded(coder, texts):
    got = coder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(got.values, got.ends[:-1])], coder.decode(got).to_pylist()


def test_every_code_point_is_as_in_the_library():
    coder, t = bpe.WordBpe(VOCAB), library()
    texts = [f"b{chr(c)}b {chr(c) * 2}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(texts), 100_000):
        part = texts[at : at + 100_000]
        assert encoded(coder, part)[0] == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("size", [8 << 20, 300])
def test_random_texts_in_slices_of_any_size(monkeypatch, size):
    monkeypatch.setattr(ragged, "SLICE_BYTES", size)
    rng, coder, t = random.Random(size), bpe.WordBpe(VOCAB), library()
    letters = "abcdefgh '’.,!?0123 ÉéßΣσİ日本\u3000\xa0\ń<|>S'tT're"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(3000)] + [rng.choice(ODD) + "<|endoftext|>" + rng.choice(ODD) for _ in range(200)]
    ids, back = encoded(coder, texts)
    expected = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert ids == expected and back == [t.decode(e, skip_special_tokens=False) for e in expected]


def test_bounds_and_best_fit():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(1, 101, rng.integers(1, 300))
        bins, offsets, made = packing.best_fit_decreasing(sizes, 100)
        low = packing.bin_lower_bound(sizes, 100)
        assert low >= -(-sizes.sum() // 100) and low <= made
        for b in range(made):
            at = np.flatnonzero(bins == b)
            at = at[np.argsort(offsets[at])]
            assert (offsets[at] == np.concatenate([[0], np.cumsum(sizes[at])[:-1]])).all() and sizes[at].sum() <= 100
    assert packing.bin_lower_bound(np.array([60] * 5), 100) == 5


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by)


def test_packing_pieces_and_sequences(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, None), (5, "again"), (5, "again")], "doc_id long, text string"))
    rows = packing.pack_documents(df, VOCAB, 4096, 1).collect()
    n = check_packing(rows, 4096)
    assert n <= -(-sum(r["length"] for r in rows) // 4096) + 1
    t, texts = library(), {r["doc_id"]: r["text"] for r in df.where("doc_id <> 5").collect()}
    for r in rows:
        if r["doc_id"] in texts:
            ids = np.array([*t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1], "<u4")[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(ids.tobytes()) == r["ids_crc32"] and len(ids) == r["length"] and r["start"] == 4096 * r["piece"]
    assert packing.pack_documents(df.limit(0), VOCAB).count() == 0


def test_packing_exchanges_between_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    rng = random.Random(4)
    sizes = [rng.choice([3, 7, 20, 33, 34, 51, 66, 100]) for _ in range(600)]
    rows = packing.best_fit_pack(spark.createDataFrame([(i, n, "kept") for i, n in enumerate(sizes)], ["doc_id", "length", "offset"]), 100).collect()
    assert len(rows) == 600
    single = packing.best_fit_decreasing(np.array(sizes), 100)[2]
    assert check_packing(rows, 100) <= single + 12


def test_logistic_weights():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert np.abs(fit_logistic(x, y, 1e-6) - [2, -1, 0.5]).max() < 0.3
    assert fit_logistic(np.zeros((0, 2)), np.zeros(0))[-1] == pytest.approx(0)


def test_toxicity_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    out = toxicity.toxicity_scores(d.withColumn("score", F.lit("clash")), labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    pos, neg = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([p > n for p in pos for n in neg]) > 0.75
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    for r in rows[:50]:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2


@pytest.mark.parametrize("word_discount, pair_discount, share, docs_each, unlabelled, toxic_share", [(0.5, 1.0, 1.2, 60, 0, 0.3), (toxicity.WORD_DISCOUNT, toxicity.PAIR_DISCOUNT, toxicity.SHARED, 400, 2500, 0.05)])
def test_class_models_against_plain_python(spark, monkeypatch, word_discount, pair_discount, share, docs_each, unlabelled, toxic_share):
    monkeypatch.setattr(toxicity, "WORD_DISCOUNT", word_discount)
    monkeypatch.setattr(toxicity, "PAIR_DISCOUNT", pair_discount)
    monkeypatch.setattr(toxicity, "SHARED", share)
    rng = random.Random(8)
    ordinary, toxic = "the of cat dog runs home now".split(), "the of cat dog You fool, idiot runs".split()
    text = lambda words: " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))
    texts = [(text(toxic if y else ordinary), y) for y in (0, 1) for _ in range(docs_each)]
    rest = [("never labelled words", None)] + [(text(ordinary), None) for _ in range(unlabelled)]
    df = spark.createDataFrame([*texts, *rest], "text string, y int")
    model = toxicity.estimate(df, df.where("y IS NOT NULL"), toxic_share)
    split = lambda t: [toxicity.bare(w) for w in t.split()]
    df_all = Counter(w for t, _ in [*texts, *rest] for w in set(split(t)))
    mass = sum(df_all.values()) + 0.5 * (len(df_all) + 1)
    shared = {w: (n + 0.5) / mass for w, n in df_all.items()}
    vocabulary = [*df_all, "<any other>"]
    shared["<any other>"] = 0.5 / mass
    c = [Counter(w for t, k in texts if k == y for w in set(split(t))) for y in (0, 1)]
    pairs = [Counter(p for t, k in texts if k == y for p in set(zip(["<s>", *split(t)], split(t)))) for y in (0, 1)]
    h = [Counter() for _ in range(2)]
    for y in (0, 1):
        for (a, _), n in pairs[y].items():
            h[y][a] += n
    weight = [(1 - toxic_share) / docs_each, toxic_share / docs_each]

    def own(y, w):
        total = sum(c[y].values())
        return max(c[y][w] - word_discount - share * total * shared[w], 0) / total

    def pair_own(y, a, b):
        together = sum(pairs[k][a, b] * weight[k] for k in (0, 1)) / (sum(h[k][a] * weight[k] for k in (0, 1)) or 1)
        return max(pairs[y][a, b] - pair_discount - share * h[y][a] * together, 0) / max(h[y][a], 1)

    def p(y, a, b):
        first = own(y, b) + (1 - sum(own(y, w) for w in vocabulary)) * shared[b]
        return pair_own(y, a, b) + (1 - sum(pair_own(y, a, w) for w in vocabulary)) * first

    for y in (0, 1):
        for a in ("<s>", "the", "fool", "home"):
            assert sum(p(y, a, b) for b in vocabulary) == pytest.approx(1)
    assert len(model.pairs) and len(model.words)
    for t in ("The cat, you fool! idiot", "home now", "unheard of words fool", ""):
        expected = [np.log(p(1, a, b) / p(0, a, b)) for a, b in zip(["<s>", *split(t)], [w if w in df_all else "<any other>" for w in split(t)])]
        assert model.scorer().means(pa.array([t]))[0] == pytest.approx(np.mean(expected) if expected else 0)


def test_toxicity_edge_cases(spark):
    d = docs(spark, [(i, "you idiot moron" if i % 3 == 0 else "a fine day outside", None) for i in range(60)] + [(None, None, None), (1, "", None)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = {(r["doc_id"], r["score"] >= 0.3) for r in toxicity.toxicity_scores(d, labels).collect() if r["doc_id"] is not None and r["doc_id"] > 1}
    assert all(flag == (i % 3 == 0) for i, flag in got)
    none = toxicity.toxicity_scores(d, labels.limit(0))
    assert none.count() == 62 and none.where("score IS NULL").count() == 0
    assert toxicity.toxicity_scores(d.limit(0), labels).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark):
    base = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rows = quality.quality_scores(d, labels).join(labels, "doc_id").collect()
    clean = [r["keep"] for r in rows if r["quality"]]
    junk = [r["keep"] for r in rows if not r["quality"]]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.05


def test_quality_of_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "p"), (2, "", "q"), (2, "", "q"), (None, "a plain sentence of some words", "r"), (5, "#### $$$$ " * 50, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, path_p string")
    for c in ("host", "path", "own", "row", "h", "q", "host_p", "global_p", "quality_score"):
        d = d.withColumn(c, F.lit(f"own {c}"))
    labels = spark.createDataFrame([(5, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = quality.with_quality(d, labels, F.col("path_p"), F.col("host"))
    assert out.columns == d.columns and [r["path_p"] for r in out.orderBy("path_p").collect()] == [None, "p", "q", "q", "r"]
    assert out.where("own <> 'own own' OR host <> 'own host' OR quality_score NOT BETWEEN 0 AND 1").count() == 0
    assert quality.with_quality(d.limit(0), labels.limit(0), F.col("path_p"), F.col("host")).count() == 0


def test_site_posteriors_shrink_sparse_sites(spark):
    rows = [("big", "big/a", 0.9)] * 400 + [("big", "big/b", 0.1)] * 400 + [("bad", "bad/x", 0.02)] * 300 + [("tiny", "tiny/x", 0.0)] + [(None, None, 0.5)]
    out = {(r["host"], r["path"]): r for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    g = out["tiny", "tiny/x"]["global_p"]
    assert out["big", "big/a"]["path_p"] > 0.8 > 0.3 > out["big", "big/b"]["path_p"]
    assert out["bad", "bad/x"]["host_p"] < 0.1 < out["tiny", "tiny/x"]["host_p"] < g
    assert (None, None) in out
    assert quality.site_posteriors(spark.createDataFrame([], "host string, path string, p double")).count() == 0
