"""The pipeline's stages, one after the other, against what each must keep."""

import random
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quorumkit.llm import bpe, packing, quality, queries, simhash
from quorumkit.llm.common import BATCH_BYTES, materialize
from quorumkit.sinks.shared import new_path, run_folder, scratch

from .test_dedup_operators import brute_components, brute_rest, reference_print, reference_shingles

BASE = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{BASE}/labels.parquet").collect()}
    columns = docs.columns
    kept = [materialize(docs)]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], BASE)))
    start, clean, good, single, cut, packed = kept
    assert all(k.columns == columns for k in kept[:-1])
    ids = lambda df: [r["doc_id"] for r in df.select("doc_id").collect()]
    assert set(ids(good)) <= set(ids(clean)) <= set(ids(start))
    fine = [i for i, r in labels.items() if r["quality"] and not r["toxic"] and i in set(ids(start))]
    assert len(set(fine) & set(ids(good))) >= 0.95 * len(fine)

    rows = good.select("doc_id", "text").collect()
    prints = [reference_print(r["text"], corpus_pipeline.STAGE_SHINGLE_WORDS) for r in rows]
    sets = [reference_shingles(r["text"], corpus_pipeline.STAGE_SHINGLE_WORDS) for r in rows]
    linked = lambda a, b: (a[0] ^ b[0]).bit_count() <= corpus_pipeline.STAGE_MAX_BITS or 10 * len(a[1] & b[1]) >= 8 * len(a[1] | b[1]) > 0
    roots = brute_components(list(zip(prints, sets)), linked)
    first = {}
    for r, root in zip(rows, roots):
        first[root] = min(first.get(root, r["doc_id"]), r["doc_id"])
    assert sorted(ids(single)) == sorted(first.values())

    rows = single.select("doc_id", "text").collect()
    expected = {r["doc_id"]: t for r, t in zip(rows, brute_rest([r["text"] for r in rows], corpus_pipeline.STAGE_SPAN))}
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert {i: t or "" for i, t in got.items()} == expected
    pieces = packed.collect()
    assert set(r["doc_id"] for r in pieces) == set(ids(cut)) and max(r["offset"] + r["length"] for r in pieces) <= queries.CAPACITY


def test_names_and_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "SimHash near-dedup", "suffix-array dedup", "best-fit packing"]


def test_stages_take_odd_rows_and_no_rows(spark, tmp_path):
    passage = " ".join(f"word{i * 37 % 101}" for i in range(52))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "some few plain words here", "en", "a", 25), (3, "some few plain words here", "en", "a", 25), (None, "others of no number at all", "en", None, 26)]
    rows += [(10 + i, f"{chr(97 + i) * 5} begins and goes on to say that {passage} and then {chr(120 - i) * 6} ends as it has to.", "en", "a", 0) for i in range(3)]
    # the three above are alike to 0.83, so one of them stays; those below share the passage alone
    rows += [(20 + i, " ".join(f"{chr(97 + i)}{j * 31 % 89}" for j in range(60)) + f" {passage} " + " ".join(f"{chr(107 + i)}{j * 29 % 83}" for j in range(60)), "en", "a", 0) for i in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)))
            if name == "SimHash near-dedup" and data:
                assert {r["doc_id"] for r in docs.collect()} >= {20, 21, 22} and docs.where("doc_id between 10 and 19").count() == 1
            if name == "suffix-array dedup":
                assert all(passage[5:-5] not in (r["text"] or "") for r in docs.collect())
        assert (docs.count() > 0) == bool(data)


def test_texts_reach_workers_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    rows = spark.range(3000).selectExpr("id as doc_id", "repeat('some words ', 400) as text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    try:
        for name, stage in corpus_pipeline.STAGES[-2:]:
            spark.conf.unset(key)
            stage(spark, rows.limit(0).selectExpr("doc_id", "text", "text as lang", "text as source", "doc_id as n_chars"), BASE)
            got = rows.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r["n"] for r in got) == 3000 and max(r["size"] for r in got) < BATCH_BYTES + 10_000, name
        spark.conf.set(key, 1 << 20)
        packing.pack_documents(rows.limit(0), queries.VOCAB_PATH)
        assert spark.conf.get(key) == str(1 << 20)  # a session's own limit stays
    finally:
        spark.conf.unset(key)


def test_encoding_of_a_batch_takes_bounded_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 11))) for _ in range(20_000)]
    texts = pa.array([" ".join(rng.choices(words, k=300)) for _ in range(1700)])
    assert 3 << 20 < texts.nbytes < 4 << 20
    coder = bpe.worker_bpe(queries.VOCAB_PATH)
    tracemalloc.start()
    try:
        got = packing._pieces_of(coder, texts, 4096, 1, True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20
    whole = packing._cut_pieces(coder.encode(texts), 4096, 1, True)
    assert got.equals(whole)


def left_by(spark, run):
    """What ``run`` returns, and the columns of the tables that it leaves in the shared folder (of files of numbers: their folder)."""
    here = Path(run_folder(spark).removeprefix("file:"))
    there = {p.name for p in here.glob("*")}
    out = run()
    return out, [spark.read.parquet(str(p)).columns for p in here.glob("*") if p.name not in there]


def test_tables_that_nothing_reads_are_deleted(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean, left = left_by(spark, lambda: stages["toxicity"](spark, docs, BASE))
    assert left == [] and clean.count() > 0
    single, left = left_by(spark, lambda: stages["SimHash near-dedup"](spark, docs, BASE))
    assert sorted(left) == [[*docs.columns, "__sketch", "__row"], ["number", "stretch"]] and single.count() > 0
    packed, left = left_by(spark, lambda: corpus_pipeline.run(spark, BASE))
    assert [c for c in left if "text" in c] == [docs.columns] and packed.count() > 0


def test_scratch_is_deleted_also_after_an_error(spark):
    path = new_path(spark)
    with scratch(spark):
        with scratch(spark):
            inner = Path(new_path(spark).removeprefix("file:")).parent
            materialize(spark.range(3))
            kept = materialize(spark.range(5), path)
            assert any(inner.iterdir())
        assert not inner.exists() and kept.count() == 5
        outer = materialize(spark.range(2))
        assert outer.count() == 2
    assert not inner.parent.exists() and kept.count() == 5
    with pytest.raises(ZeroDivisionError), scratch(spark):
        inner = Path(new_path(spark).removeprefix("file:")).parent
        materialize(spark.range(3))
        raise ZeroDivisionError
    assert not inner.exists() and Path(new_path(spark)).parent == Path(run_folder(spark))


def test_copies_of_texts_are_compressed_well(spark):
    docs = spark.createDataFrame([(i, f"some words of number {i} and a few more of them", "en", "a", 40) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    here = Path(run_folder(spark).removeprefix("file:"))
    for run in (lambda: simhash.keep_one_of_each(docs), lambda: quality.with_quality(docs, labels, F.col("source"), F.col("source"))):
        there = {p.name for p in here.glob("*")}
        assert run().count() > 0
        copies = [f.name for p in here.glob("*") if p.name not in there and {"text", "row"} & set(spark.read.parquet(str(p)).columns) for f in p.glob("part-*")]
        assert copies and all(f.endswith(".zstd.parquet") for f in copies)
