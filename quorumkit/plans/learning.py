"""Registered queries over learning, synthesis and library assembly, with SQL for what must hold whatever was drawn or learnt."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quorumkit.functions import labels as L
from quorumkit.functions import sequence as S
from quorumkit.operators import abundance as A
from quorumkit.operators import boosting, factors, features, forests, metrics, reprofile, sequences, synth
from quorumkit.plans import inputs as I
from quorumkit.plans.catalogue import _ABUNDANCE, _CALLS, _CONTIGS, _CV, _FRAMES, _NODES, _PAIRS, _VOTED, ORACLE_SQL, _abundance, query
from quorumkit.sinks import tables as K
from quorumkit.sinks.shared import materialize, new_path

#: Size of the models behind the checks; ``reprofiled`` trains at full size.
_SMALL = {"trees": 15, "rounds": 12, "depth": 12}


def _training(spark, d):
    return I.calls(spark, d).select("sample", "seq", *I.ANNOTATORS, "length", "true")


# boosting -------------------------------------------------------------------

_SPLITS = """lab AS (SELECT "true"::int - 100 AS y, "taxID_a_0"::int AS f0, "taxID_b_0"::int AS f1, "taxID_c_0"::int AS f2, {w} AS w FROM calls),
    long AS (SELECT y, w, 0 AS feature, f0 AS v FROM lab UNION ALL SELECT y, w, 1, f1 FROM lab UNION ALL SELECT y, w, 2, f2 FROM lab),
    cell AS (SELECT feature, dense_rank() OVER (PARTITION BY feature ORDER BY v) - 1 AS bin, y, w FROM long), cells AS (SELECT feature, bin, y, sum(w) AS w FROM cell GROUP BY ALL),
    grid AS (SELECT b.feature, b.bin, l.y, coalesce(c.w, 0) AS w FROM (SELECT DISTINCT feature, bin FROM cells) b CROSS JOIN (SELECT DISTINCT y FROM cells) l LEFT JOIN cells c ON c.feature = b.feature AND c.bin = b.bin AND c.y = l.y),
    side AS (SELECT feature, bin, y, sum(w) OVER (PARTITION BY feature, y ORDER BY bin) AS a, sum(w) OVER (PARTITION BY feature, y) AS t FROM grid),
    split AS (SELECT feature, bin, sum(a) AS l, sum(t - a) AS r, sum(a * a) AS a2, sum((t - a) * (t - a)) AS b2, arg_max(y, (round(a, 9), -y)) AS left_label, arg_max(y, (round(t - a, 9), -y)) AS right_label FROM side GROUP BY ALL)
    SELECT feature::int AS feature, bin::int AS bin, round(l - a2 / l + r - b2 / r, 6) AS impurity, left_label::double AS left_label, right_label::double AS right_label FROM split WHERE l > 1e-12 AND r > 1e-12"""


@query(f"WITH {_CALLS}, {_SPLITS.format(w='1.0 / (SELECT count(*) FROM calls)')}")
def stump_splits(spark, d):
    """Impurity and sides of every split that the first round of boosting can choose."""
    rows = _training(spark, d).select(*(F.col(a).cast("double").alias(a) for a in I.ANNOTATORS), (F.col("true").cast("double") - 100).alias("label"))
    ready = VectorAssembler(inputCols=list(I.ANNOTATORS), outputCol="features").transform(rows)
    cells = boosting.cells_of(ready, "features", "label")
    limits = boosting.bin_limits(cells, "features", 256, ready)
    n = cells.agg(F.sum("n")).first()[0]
    binned = cells.select(boosting.bins_of(vector_to_array("features"), limits).alias("bins"), "label", (F.col("n") / n).alias("w"))
    out = boosting.stump_choices(boosting.weight_histogram(binned))
    return out.select("feature", "bin", F.round("impurity", 6).alias("impurity"), "left_label", "right_label")


_FIRST = ORACLE_SQL["stump_splits"]


@query(f"SELECT 0 AS round, feature, bin, left_label, right_label FROM ({_FIRST}) ORDER BY impurity, feature, bin LIMIT 1")
def first_stump(spark, d):
    """The stump that the estimator takes first."""
    rows = _training(spark, d).select(*(F.col(a).cast("double").alias(a) for a in I.ANNOTATORS), (F.col("true").cast("double") - 100).alias("label"))
    model = boosting.StumpBooster(rounds=1).fit(VectorAssembler(inputCols=list(I.ANNOTATORS), outputCol="features").transform(rows))
    return spark.createDataFrame([(i, s[0], s[1], s[3], s[4]) for i, s in enumerate(model.stumps)], "round int, feature int, bin int, left_label double, right_label double")


# the re-profiler ------------------------------------------------------------

_VOTE_LIST = """v AS (SELECT *, list_filter(["taxID_a_0"::bigint, "taxID_b_0"::bigint, "taxID_c_0"::bigint], lambda x: x > 0) AS votes FROM calls)"""


@query(
    f"""WITH {_CALLS}, {_VOTE_LIST} SELECT sample, count(*) AS n, count(*) FILTER (WHERE len(votes) = 0 OR l_linenumber % 7 = 0) AS zero, count(*) FILTER (WHERE len(votes) > 0 AND l_linenumber % 7 <> 0 AND list_min(votes) = list_max(votes)) AS agreed,
    count(*) FILTER (WHERE len(votes) > 1 AND l_linenumber % 7 <> 0 AND list_min(votes) = list_max(votes)) AS sure, 0::bigint AS strangers, true AS accurate FROM v GROUP BY sample"""
)
def reprofiled_checks(spark, d):
    """What must hold of corrected votes whatever was learnt: rows, zeros (no votes, no truth), overrides by agreement, known labels, and more than half right."""
    rows = _training(spark, d)
    model = reprofile.train(rows, **_SMALL)
    some = I.calls(spark, d).select("sample", *I.ANNOTATORS, "length", F.when(F.col("l_linenumber") % 7 != 0, F.col("true")).alias("true"))
    cells = some.groupBy(*some.columns).agg(F.count(F.lit(1)).alias("rows"))  # what is corrected alike
    out = reprofile.apply_reprofiler(cells, model, drop_without_truth=True)
    votes = F.filter(F.array(*(F.col(a).cast("long") for a in I.ANNOTATORS)), lambda v: v > 0)
    agreed = (F.col("corrected") != "0") & (F.array_min(votes) == F.array_max(votes)) & (F.col("corrected") == F.array_max(votes).cast("string"))
    count = lambda c: F.sum(c.cast("long") * F.col("rows"))
    known = F.array(*map(F.lit, ["0", *model.labels.labels]))
    same = F.col("corrected") == F.col("true")
    right = count(same) * 2 > count(same.isNotNull())
    zero = (F.col("corrected") == "0") & (F.col("corrected_confidence") == 0)
    sure = agreed & (F.size(votes) > 1) & (F.col("corrected_confidence") == 1)
    return out.groupBy("sample").agg(F.sum("rows").alias("n"), count(zero).alias("zero"), count(agreed).alias("agreed"), count(sure).alias("sure"), count(~F.array_contains(known, F.col("corrected")) & ~agreed).alias("strangers"), right.alias("accurate"))


@query(f"""WITH {_CALLS} SELECT kind, count(*) AS n, 0::bigint AS differ FROM calls, (VALUES ('AdaBoost'), ('RandomForest')) k(kind) GROUP BY kind""")
def saved_reprofilers(spark, d):
    """Models of both kinds, written, read again and applied: no label or confidence differs."""
    rows = _training(spark, d)
    forest = reprofile.train(rows, trees=5, rounds=2, depth=5)
    cells = materialize(rows.groupBy(*I.ANNOTATORS, "length", "true").agg(F.count(F.lit(1)).alias("rows")))  # what is corrected alike
    ready = forest.labels.transform(reprofile.assemble(cells, forest.features))
    both = {"RandomForest": forest.model, "AdaBoost": reprofile.fit_boosted(ready, 4, "rows")} if forest.name == "RandomForest" else {"AdaBoost": forest.model}
    out = None
    for kind, learnt in both.items():
        model, path = reprofile.Reprofiler(kind, learnt, forest.labels, forest.features, {}), new_path(spark)
        reprofile.save_model(model, path)
        pick = lambda m, sign: reprofile.apply_reprofiler(cells, m).select(*I.ANNOTATORS, "length", "corrected", F.round("corrected_confidence", 9).alias("sure"), (F.col("rows") * sign).alias("sign"))
        both_sides = pick(model, 1).unionByName(pick(reprofile.load_model(spark, path), -1)).groupBy(*I.ANNOTATORS, "length", "corrected", "sure").agg(F.sum("sign").alias("left"), F.sum(F.greatest("sign", F.lit(0))).alias("n"))
        got = both_sides.groupBy(F.lit(kind).alias("kind")).agg(F.sum("n").alias("n"), F.sum(F.abs("left")).alias("differ"))
        out = got if out is None else out.unionByName(got)
    return out


@query(f"""WITH {_CALLS} SELECT sample || '_reprofiled.csv' AS file, count(*) AS n, count(*) FILTER (WHERE {_VOTED}) AS unclassified FROM calls GROUP BY sample""")
def reprofiled_directory(spark, d):
    """A folder of vote files, learnt from and re-profiled into a folder of named files."""
    folder, out = new_path(spark), new_path(spark)
    K.write_votes(_training(spark, d), folder)
    reprofile.reprofile_directory(spark, [folder], [folder], out, trees=5, rounds=2, depth=6)
    back = spark.read.csv(out, header=True)
    none = (F.col("corrected") == "0") & (F.col("corrected_confidence").cast("double") == 0)
    return back.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.sum(none.cast("long")).alias("unclassified"))


@query(
    f"""WITH {_CALLS}, p AS (SELECT l_linenumber % 3 AS y, unnest([confidence, (1 - confidence) / 4, (1 - confidence) * 3 / 4]) AS score, unnest([0, 1, 2]) AS k FROM calls),
    c AS (SELECT round(score, 9) AS score, sum((k = y)::int) AS p, sum((k <> y)::int) AS n FROM p GROUP BY 1), b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
    SELECT round(sum(p * (below + n / 2.0))::double / (sum(p) * sum(n))::double, 6) AS auc, sum(p)::bigint AS positives, sum(n)::bigint AS negatives FROM b"""
)
def micro_auc(spark, d):
    """The micro-averaged area over one-hot truth and flattened class probabilities."""
    c = F.col("confidence")
    rows = I.calls(spark, d).select((F.col("l_linenumber") % 3).alias("label"), array_to_vector(F.array(c, (1 - c) / 4, (1 - c) * 3 / 4)).alias("probability"))
    points = reprofile.roc_points(rows).withColumn("score", F.round("score", 9))
    return reprofile.auc_table(points).withColumn("auc", F.round("auc", 6))


# labels, sequences, synthesis -----------------------------------------------


@query(
    f"""WITH {_NODES}, alias AS (SELECT rank, unnest([upper(rank), CASE rank WHEN 'species' THEN 'sp' WHEN 'genus' THEN ' Genera ' ELSE 'RAW' END]) AS given FROM (SELECT DISTINCT rank FROM nodes WHERE rank <> 'no rank'))
    SELECT given, CASE WHEN given = 'RAW' THEN NULL ELSE rank END AS full_name, CASE WHEN given = 'RAW' THEN 'taxid_taxid' WHEN rank = 'genus' THEN 'genera_taxid' ELSE rank || '_taxid' END AS column_name FROM alias"""
)
def rank_names(spark, d):
    """Ranks of the tree by several names, in full, and the columns that hold them."""
    ranks = [r["rank"] for r in I.nodes(spark, d).where("rank <> 'no rank'").select("rank").distinct().collect()]  # the names of ranks, a handful
    given = [g for r in ranks for g in (r.upper(), {"species": "sp", "genus": " Genera "}.get(r, "RAW"))]
    return spark.createDataFrame([(g, L.normalize_rank(g), L.rank_column(g)) for g in given], "given string, full_name string, column_name string")


@query(
    f"""WITH {_CONTIGS}, k AS (SELECT header, unnest(list_transform(range(1, length(sequence)), lambda i: substr(sequence, i, 2))) AS kmer FROM contigs WHERE length(sequence) >= 2), c AS (SELECT header, kmer, count(*) AS n FROM k GROUP BY ALL)
    SELECT kmer, round(sum(share), 4) AS total, count(*) AS reads FROM (SELECT kmer, n::double / sum(n) OVER (PARTITION BY header) AS share FROM c) GROUP BY kmer"""
)
def kmer_frequencies(spark, d):
    """Normalised pair frequencies of each contig, added up."""
    profiles = features.kmer_profiles(I.contigs(spark, d).select(F.col("sequence").alias("seq")), 2)
    each = profiles.select(F.posexplode(vector_to_array("kmers")).alias("at", "share")).where("share > 0")
    names = F.array(*map(F.lit, S.kmer_vocabulary(2)))
    return each.groupBy(F.get(names, F.col("at")).alias("kmer")).agg(F.round(F.sum("share"), 4).alias("total"), F.count(F.lit(1)).alias("reads"))


@query(
    f"""WITH {_FRAMES.replace("aa AS (SELECT file", "aa AS MATERIALIZED (SELECT file")}, genes AS (SELECT taxid, 'p' || contig_no AS id, split_part(aa, '*', 1) AS aa FROM aa WHERE strand = 1 AND frame = 0 AND taxid::int % 3 <> 0),
    own AS (SELECT taxid, id, replace(aa, 'X', '') AS aa FROM genes WHERE length(replace(aa, 'X', '')) >= 10)
    SELECT taxid, id, md5(aa) AS aa_md5 FROM own UNION ALL SELECT taxid, 'c' || contig_no || 's' || strand || 'f' || frame, md5(replace(aa, '*', 'X')) FROM aa WHERE taxid NOT IN (SELECT taxid FROM own)"""
)
def protein_library(spark, d):
    """Proteins of the labels that have any, six-frame rows of all others."""
    contigs = materialize(I.contigs(spark, d))  # genes, frames and labels all start from it
    line = contigs.where("cast(taxid AS int) % 3 <> 0").select(F.col("header").alias("seqid"), F.lit("CDS").alias("type"), F.lit(1).cast("long").alias("start"), F.length("sequence").cast("long").alias("end"), F.lit("+").alias("strand"), F.lit(0).alias("phase"), F.create_map(F.lit("ID"), F.concat(F.lit("p"), "header")).alias("attrs"))
    genes = sequences.coding_sequences(line, contigs).join(contigs.select(F.concat(F.lit("p"), "header").alias("protein_id"), "taxid"), "protein_id")
    frames = sequences.six_frames(contigs)
    labels = contigs.select("taxid").distinct()
    return sequences.protein_library(labels, genes.select("taxid", F.col("protein_id").alias("id"), "aa"), frames).select("taxid", "id", F.md5("aa").alias("aa_md5"))


@query(
    f"""WITH {_ABUNDANCE}, f AS (SELECT *, n::double / sum(n) OVER (PARTITION BY annotator, sample) AS share FROM ab), k AS (SELECT annotator, taxid FROM f GROUP BY ALL HAVING max(share) >= 0.041)
    SELECT mode, annotator, sample, taxid, n::double AS n FROM ab JOIN k USING (annotator, taxid), (VALUES ('Preserve'), ('direct')) m(mode)"""
)
def regenerated_by_name(spark, d):
    """The same mode under two names, with the threshold's old spelling."""
    out = None
    for mode in ("Preserve", "direct"):
        got = synth.regenerate(_abundance(spark, d), mode, treshhold_amount=0.041).where("n > 0").select(F.lit(mode).alias("mode"), "annotator", "sample", "taxid", F.col("n").cast("double").alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


@query(
    f"""WITH RECURSIVE {_CV}, e AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(freq) AS w FROM (SELECT a, b, sum(freq) AS freq FROM cv WHERE a <> b GROUP BY ALL) GROUP BY 1, 2),
    r AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY w DESC, a, b) AS k FROM e),
    reach(k, node) AS (SELECT k, a FROM r UNION SELECT reach.k, CASE WHEN r.a = reach.node THEN r.b ELSE r.a END FROM reach JOIN r ON r.k < reach.k AND (r.a = reach.node OR r.b = reach.node))
    SELECT a, b, w::bigint AS w FROM r WHERE NOT EXISTS (SELECT 1 FROM reach WHERE reach.k = r.k AND reach.node = r.b)"""
)
def label_forest(spark, d):
    """The maximum spanning forest of labels by how often they are confused; in SQL the edges whose ends no heavier edges join."""
    pairs = metrics.cross_validation_of_reads(I.calls(spark, d), I.ANNOTATORS).groupBy("a", "b").agg(F.sum("freq").alias("w"))
    return forests.spanning_forest(pairs.select(F.lit("all").alias("g"), "a", "b", "w")).select("a", "b", "w")


@query(f"WITH {_CALLS} SELECT 'observed' AS how, count(DISTINCT sample) AS n FROM calls UNION ALL SELECT 'asked', 7")
def numbers_of_samples(spark, d):
    """How many samples a run makes, as tables."""
    calls = I.calls(spark, d)
    return A.sample_number(calls).select(F.lit("observed").alias("how"), "n").unionByName(A.sample_number(calls, 7).select(F.lit("asked").alias("how"), "n"))


@query(
    f"""WITH {_PAIRS}
    SELECT how, taxid, round(avg(ln(1 + n)), 4) AS mean, round(var_pop(ln(1 + n)), 4) AS variance, 2::bigint AS factors FROM g, (VALUES ('one task'), ('grouped sums')) h(how) GROUP BY ALL"""
)
def factor_parts(spark, d):
    """Whatever a factor model finds, a label's loadings and its own rest add up to its variance; fitted in one task and by grouped sums (at any step, so few are taken)."""
    values = A.complete(I.events_abundance(spark, d)).select("annotator", "sample", "taxid", F.log1p(F.col("n").cast("double")).alias("x"))
    out = None
    for how, cells in (("one task", factors.SMALL_CELLS), ("grouped sums", 0)):
        parts = F.aggregate(F.transform("load", lambda v: v * v), F.col("own"), lambda s, v: s + v)
        got = factors.factor_model(values, 2, cells, 0.1).select(F.lit(how).alias("how"), "taxid", F.round("mean", 4).alias("mean"), F.round(parts, 4).alias("variance"), F.size("load").cast("long").alias("factors"))
        out = got if out is None else out.unionByName(got)
    return out
