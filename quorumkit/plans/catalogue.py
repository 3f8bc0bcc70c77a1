"""Registered queries and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumkit.functions import labels as L
from quorumkit.functions import sequence as S
from quorumkit.operators import abundance as A
from quorumkit.operators import allocate, combine, features, metrics, registry, reprofile, sequences, synth, taxonomy
from quorumkit.plans import inputs as I
from quorumkit.sinks import tables as K
from quorumkit.sinks.shared import materialize
from quorumkit.sources import reports, sequences as seqio, tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_CALLS = f"calls AS ({I.duck(I.CALLS)})"
_VOTES = _CALLS + """, votes AS (
    SELECT sample, seq, "true", 'taxID_a_0' AS annotator, "taxID_a_0" AS label FROM calls
    UNION ALL SELECT sample, seq, "true", 'taxID_b_0', "taxID_b_0" FROM calls
    UNION ALL SELECT sample, seq, "true", 'taxID_c_0', "taxID_c_0" FROM calls)"""
_COUNTS = _VOTES + """, seen AS (SELECT DISTINCT "true" AS t FROM votes), counts AS (
    SELECT annotator, "true", CASE WHEN label = '0' OR label IN (SELECT t FROM seen) THEN label ELSE 'other' END AS pred, count(*) AS freq
    FROM votes GROUP BY ALL)"""
_LINES = f"calls AS MATERIALIZED ({I.duck(I.CALLS)}), lines AS MATERIALIZED ({I.duck(I.LINES)})"
_REPORT = _LINES + """, report AS MATERIALIZED (
    SELECT sample, tool, run_idx, string_split(value, chr(9))[2] AS seq,
           CASE WHEN tool = 'kaiju' THEN string_split(value, chr(9))[3] ELSE regexp_extract(string_split(value, chr(9))[3], '(?i)taxid ([0-9]+)', 1) END AS taxid,
           CASE WHEN tool = 'kaiju' THEN NULL ELSE string_split(string_split(value, chr(9))[4], '|')[1] END AS length, line_no
    FROM lines)"""
_ABUNDANCE = _VOTES + """, ab AS (SELECT annotator, sample, label AS taxid, count(*) AS n FROM votes GROUP BY ALL)"""
_NODES = f"nodes AS ({I.duck(I.NODES)})"
_LETTERS = """letters AS (SELECT cast(doc_id AS varchar) AS read_id, doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq, source, lang FROM documents)"""
_CONTIGS = _LETTERS + f""", contigs AS (SELECT source AS file, regexp_replace(source, '[^0-9]', '', 'g') AS taxid, doc_id AS contig_no, read_id AS header, translate(seq, '{I.BASES[0]}', '{I.BASES[1]}') AS sequence FROM letters WHERE seq <> '')"""


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion(metrics.collapse_other(I.votes(spark, d)))


def _abundance(spark: SparkSession, d: str) -> DataFrame:
    return A.count_votes(I.votes(spark, d))


def _genomes(spark: SparkSession, d: str) -> DataFrame:
    """Labels with a genome: nations whose key is not a multiple of four."""
    return I.table(spark, d, "nation").where("n_nationkey % 4 <> 0").select((F.col("n_nationkey") + 100).cast("string").alias("taxid"))


_GENOMES = "genomes AS (SELECT cast(n_nationkey + 100 AS varchar) AS taxid FROM nation WHERE n_nationkey % 4 <> 0)"

# scores ---------------------------------------------------------------------


@query(f"WITH {_COUNTS} SELECT annotator, round(sum(CASE WHEN \"true\" = pred THEN freq ELSE 0 END)::double / sum(freq), 6) AS f1, sum(freq)::bigint AS n FROM counts GROUP BY annotator")
def score_f1(spark, d):
    return metrics.f1_scores(_counts(spark, d)).withColumn("f1", F.round("f1", 6))


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def score_confusion(spark, d):
    return _counts(spark, d)


@query(
    f"""WITH {_COUNTS}, t AS (SELECT annotator, "true" AS label, sum(freq) AS t FROM counts GROUP BY ALL), p AS (SELECT annotator, pred AS label, sum(freq) AS p FROM counts GROUP BY ALL),
    b AS (SELECT annotator, t, coalesce(p, 0) AS p, avg(t) OVER (PARTITION BY annotator) AS m FROM t LEFT JOIN p USING (annotator, label))
    SELECT annotator, round(1 - sum((t - p) * (t - p))::double / sum((t - m) * (t - m)), 6) AS r2 FROM b GROUP BY annotator"""
)
def score_r2(spark, d):
    return metrics.r2_scores(_counts(spark, d)).withColumn("r2", F.round("r2", 6))


@query(
    f"""WITH {_COUNTS}, t AS (SELECT annotator, "true" AS label, sum(freq) AS t, sum(CASE WHEN "true" = pred THEN freq ELSE 0 END) AS h FROM counts GROUP BY ALL), p AS (SELECT annotator, pred AS label, sum(freq) AS p FROM counts GROUP BY ALL)
    SELECT annotator, round(avg(2 * h::double / (t + coalesce(p, 0))), 6) AS macro_f1 FROM t LEFT JOIN p USING (annotator, label) GROUP BY annotator"""
)
def score_macro_f1(spark, d):
    return metrics.macro_f1(_counts(spark, d)).withColumn("macro_f1", F.round("macro_f1", 6))


_CV = _VOTES + """, cv AS (SELECT x.annotator AS annotator_a, y.annotator AS annotator_b, x.label AS a, y.label AS b, count(*) AS freq
    FROM votes x JOIN votes y ON x.sample = y.sample AND x.seq = y.seq AND x.annotator < y.annotator GROUP BY ALL)"""


@query(f"WITH {_CV} SELECT * FROM cv")
def cross_validation(spark, d):
    return metrics.cross_validation_of_reads(I.calls(spark, d), I.ANNOTATORS)


@query(
    f"""WITH {_CV}, u AS (SELECT annotator_a, annotator_b, a AS label, freq FROM cv UNION ALL SELECT annotator_a, annotator_b, b, freq FROM cv),
    s AS (SELECT annotator_a, annotator_b, label, sum(freq) AS t FROM u WHERE label NOT IN ('0','other','') GROUP BY ALL),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY annotator_a, annotator_b ORDER BY t DESC, label) AS r FROM s) WHERE r <= 9)
    SELECT cv.annotator_a, cv.annotator_b, CASE WHEN a = '0' OR k1.label IS NOT NULL THEN a ELSE 'other' END AS a, CASE WHEN b = '0' OR k2.label IS NOT NULL THEN b ELSE 'other' END AS b, sum(freq)::bigint AS freq
    FROM cv LEFT JOIN k k1 ON k1.annotator_a = cv.annotator_a AND k1.annotator_b = cv.annotator_b AND k1.label = a LEFT JOIN k k2 ON k2.annotator_a = cv.annotator_a AND k2.annotator_b = cv.annotator_b AND k2.label = b GROUP BY ALL"""
)
def cross_validation_top(spark, d):
    return metrics.collapse_top(metrics.cross_validation_of_reads(I.calls(spark, d), I.ANNOTATORS), 10)


@query(f"""WITH {_CALLS} SELECT "taxID_a_0" = "true" AS taxID_a_0, "taxID_b_0" = "true" AS taxID_b_0, "taxID_c_0" = "true" AS taxID_c_0, count(*) AS n FROM calls GROUP BY ALL""")
def correctness_counts(spark, d):
    return metrics.correctness_counts(I.calls(spark, d), list(I.ANNOTATORS))


@query(f"""WITH {_CALLS} SELECT "true", count(*) AS n FROM calls GROUP BY ALL""")
def truth_counts(spark, d):
    return metrics.truth_counts(I.calls(spark, d))


@query(
    f"""WITH {_CALLS} SELECT "taxID_a_0" AS label, count(*) AS n, round(min(confidence), 6) AS low, round(quantile_cont(confidence, 0.25), 6) AS q1, round(quantile_cont(confidence, 0.5), 6) AS median, round(quantile_cont(confidence, 0.75), 6) AS q3, round(max(confidence), 6) AS high
    FROM calls GROUP BY ALL ORDER BY n DESC, label LIMIT 10"""
)
def confidence_summary(spark, d):
    out = metrics.confidence_summary(I.calls(spark, d), "taxID_a_0", "confidence", 10)
    return out.select("label", "n", *(F.round(c, 6).alias(c) for c in ("low", "q1", "median", "q3", "high")))


@query(
    f"""WITH {_CV}, x AS (SELECT a, b, sum(freq) AS freq FROM cv GROUP BY ALL),
    ra AS (SELECT a, row_number() OVER (ORDER BY a IN ('0','other'), sum(freq) DESC, a) AS r FROM x GROUP BY a), rb AS (SELECT b, row_number() OVER (ORDER BY b IN ('0','other'), sum(freq) DESC, b) AS r FROM x GROUP BY b)
    SELECT a, b, freq::bigint AS freq FROM x WHERE a IN (SELECT a FROM ra WHERE r <= 12) AND b IN (SELECT b FROM rb WHERE r <= 12)"""
)
def matrix_trim(spark, d):
    pairs = metrics.cross_validation_of_reads(I.calls(spark, d), I.ANNOTATORS).groupBy("a", "b").agg(F.sum("freq").alias("freq"))
    return metrics.trim_matrix(pairs, "a", "b", 12).select("a", "b", "freq")


@query(
    f"""WITH {_COUNTS} SELECT "true", sum(CASE WHEN pred = '0' THEN freq ELSE 0 END)::bigint AS "0", sum(CASE WHEN pred = '101' THEN freq ELSE 0 END)::bigint AS "101", sum(CASE WHEN pred = '102' THEN freq ELSE 0 END)::bigint AS "102" FROM counts GROUP BY ALL"""
)
def matrix_pivot(spark, d):
    return metrics.pivot_matrix(_counts(spark, d), "true", "pred", ["0", "101", "102"])


_AXIS = _CV + """, u AS (SELECT a AS x, b AS y, freq AS f FROM cv UNION ALL SELECT b, a, freq FROM cv WHERE a <> b),
    core AS (SELECT DISTINCT x AS label FROM u WHERE x NOT IN ('0', 'other')),
    cell AS (SELECT c.label AS x, r.label AS y, coalesce(sum(f), 0)::double AS f FROM core c CROSS JOIN core r LEFT JOIN u ON u.x = c.label AND u.y = r.label GROUP BY ALL),
    centred AS MATERIALIZED (SELECT x, y, f - avg(f) OVER (PARTITION BY y) AS f FROM cell),
    col AS (SELECT y, list(f ORDER BY x) AS v FROM centred GROUP BY y),
    gram AS (SELECT list(row ORDER BY y) AS m FROM (SELECT a.y, list(list_dot_product(a.v, b.v) ORDER BY b.y) AS row FROM col a CROSS JOIN col b GROUP BY a.y)),
    power(k, m) AS (SELECT 0, m FROM gram UNION ALL SELECT k + 1, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / list_sum(list_transform(m, lambda z: list_dot_product(z, z))))) FROM power WHERE k < 24),
    axis AS (SELECT unnest(list_transform(m, lambda r: r[1])) AS w, unnest(range(1, len(m) + 1)) AS i FROM power WHERE k = 24),
    score AS (SELECT x AS label, sum(f * w) AS s FROM centred JOIN (SELECT label, row_number() OVER (ORDER BY label) AS i FROM core) n ON n.label = y JOIN axis ON axis.i = n.i GROUP BY x),
    turned AS (SELECT label, s * (SELECT sign(arg_max(s, abs(s))) FROM score) AS s, false AS last FROM score UNION ALL SELECT DISTINCT x, 0.0, true FROM u WHERE x IN ('0', 'other'))"""


@query(f"WITH RECURSIVE {_AXIS} SELECT label, row_number() OVER (ORDER BY last, s, label)::int AS place FROM turned")
def label_order(spark, d):
    """All labels along the principal axis; SQL finds it by squaring the product matrix again and again."""
    pairs = metrics.cross_validation_of_reads(I.calls(spark, d), I.ANNOTATORS).groupBy("a", "b").agg(F.sum("freq").alias("freq"))
    return metrics.label_order(pairs)


@query(
    f"""WITH {_CALLS}, s AS (SELECT annotator, confidence AS score, (label = "true")::int AS y FROM calls UNPIVOT (label FOR annotator IN ("taxID_a_0", "taxID_b_0", "taxID_c_0"))), c AS (SELECT annotator, score, sum(y) AS p, count(*) - sum(y) AS n FROM s GROUP BY ALL),
    b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY annotator ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
    SELECT annotator, round(sum(p * (below + n / 2.0))::double / (sum(p) * sum(n))::double, 6) AS auc, sum(p)::bigint AS positives, sum(n)::bigint AS negatives FROM b GROUP BY annotator"""
)
def vote_auc(spark, d):
    """How well the confidence tells right votes from wrong ones, with many equal scores."""
    votes = I.calls(spark, d).unpivot(["seq", "true", "confidence"], list(I.ANNOTATORS), "annotator", "label")
    points = votes.select("annotator", F.col("confidence").alias("score"), (F.col("label") == F.col("true")).cast("double").alias("label"))
    return reprofile.auc_table(points, ["annotator"]).withColumn("auc", F.round("auc", 6))


@query(
    f"""WITH {_CALLS}, c AS (SELECT l_quantity AS score, sum(("taxID_a_0" = "true")::int) AS p, sum(("taxID_a_0" <> "true")::int) AS n FROM calls GROUP BY ALL)
    SELECT score, round(sum(n) OVER (ORDER BY score DESC)::double / (SELECT sum(n) FROM c), 6) AS fpr, round(sum(p) OVER (ORDER BY score DESC)::double / (SELECT sum(p) FROM c), 6) AS tpr FROM c"""
)
def vote_roc(spark, d):
    points = I.calls(spark, d).select(F.col("l_quantity").alias("score"), (F.col("taxID_a_0") == F.col("true")).cast("double").alias("label"))
    return reprofile.roc_curve(points).select("score", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    """WITH w AS (SELECT DISTINCT substr(c_name, length(c_name) - c_custkey % 6) AS part FROM customer), t AS (SELECT DISTINCT s_name FROM supplier)
    SELECT part, count(*) AS n, min(s_name) AS first_name FROM w JOIN t ON contains(s_name, part) GROUP BY part"""
)
def substring_index(spark, d):
    """Names that contain parts of one to six letters."""
    c = I.table(spark, d, "customer").select(F.expr("substr(c_name, cast(length(c_name) - c_custkey % 6 AS int))").alias("part")).distinct()
    found = sequences.containing(c, "part", I.table(spark, d, "supplier").select("s_name").distinct(), "s_name")
    return found.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("s_name").alias("first_name"))


# reports and combination ----------------------------------------------------


@query(f"WITH {_REPORT} SELECT * FROM report")
def report_parse(spark, d):
    return reports.parse_reports(I.lines(spark, d))


_VOTE = "arg_min(taxid, line_no) FILTER (WHERE tool = '{}')"


@query(
    f"""WITH {_REPORT} SELECT sample, seq, coalesce({_VOTE.format('kaiju')}, '0') AS "taxID_kaiju_0", coalesce({_VOTE.format('kraken2')}, '0') AS "taxID_kraken2_0",
    coalesce(arg_min(length, line_no) FILTER (WHERE tool = 'kraken2'), '') AS length, regexp_extract(seq, '(?i)taxid:([0-9]+)', 1) AS "true" FROM report GROUP BY sample, seq"""
)
def combine_votes(spark, d):
    return combine.combine_reports(reports.parse_reports(I.lines(spark, d)), [("kaiju", 0), ("kraken2", 0)])


@query(f"""WITH {_REPORT} SELECT sample, seq, {_VOTE.format('kaiju')} AS "taxID_kaiju_0", {_VOTE.format('kraken2')} AS "taxID_kraken2_0" FROM report GROUP BY sample, seq""")
def combine_outer(spark, d):
    return combine.combine_reports(reports.parse_reports(I.lines(spark, d)), [("kaiju", 0), ("kraken2", 0)], fill=None).drop("length", "true")


@query(f"WITH {_REPORT} SELECT sample, tool, seq, arg_min(taxid, line_no) AS taxid FROM report GROUP BY ALL")
def report_first_of_duplicates(spark, d):
    return combine.first_of_duplicates(reports.parse_reports(I.lines(spark, d))).select("sample", "tool", "seq", "taxid")


@query(f"WITH {_VOTES} SELECT DISTINCT label FROM votes")
def distinct_labels(spark, d):
    return combine.distinct_labels(I.votes(spark, d))


@query(f"WITH {_VOTES}, {_GENOMES} SELECT DISTINCT label FROM votes WHERE label NOT IN (SELECT taxid FROM genomes)")
def missing_keys(spark, d):
    return combine.missing_keys(combine.distinct_labels(I.votes(spark, d)), _genomes(spark, d).select(F.col("taxid").alias("label")), "label")


@query(f"WITH {_CALLS} SELECT sample, count(*) AS n FROM calls GROUP BY ALL")
def rows_per_sample(spark, d):
    return combine.counts_per_sample(I.calls(spark, d))


@query("""SELECT o_orderkey AS seq, p.p_partkey AS read_id, p_size AS size FROM orders LEFT JOIN part p ON o_orderkey = p_partkey""")
def join_read_features(spark, d):
    left = I.table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"))
    feats = I.table(spark, d, "part").select(F.col("p_partkey").alias("seq"), F.col("p_partkey").alias("read_id"), F.col("p_size").alias("size"))
    return combine.join_features(left, feats)


# label algebra --------------------------------------------------------------

_TEXTS = """texts AS (SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'NaN' WHEN 2 THEN concat(cast(c_nationkey AS varchar(20)), '.0') WHEN 3 THEN concat(' tax', cast(c_nationkey AS varchar(20)))
    WHEN 4 THEN 'other' WHEN 5 THEN 'NA' WHEN 6 THEN 'Unclassified' ELSE concat('taxid:', cast(c_nationkey AS varchar(20)), '|', c_name) END AS v FROM {customer})"""


@query(
    f"""WITH {I.duck(_TEXTS)}, t AS (SELECT c_custkey, v, trim(v) AS x, regexp_replace(trim(v), '\\.0$', '') AS bare FROM texts)
    SELECT c_custkey, CASE WHEN x IS NULL OR lower(x) IN ('','nan','none','na','<na>') THEN '0' WHEN regexp_extract(bare, '(\\d+)', 1) <> '' THEN regexp_extract(bare, '(\\d+)', 1) ELSE bare END AS canonical,
    CASE WHEN v IS NULL OR v IN ('','NA','NaN','nan','None') THEN '0' ELSE v END AS combiner,
    CASE WHEN x IS NULL OR lower(x) IN ('','nan','none','na','<na>') THEN '0' WHEN lower(x) = 'other' THEN 'other' WHEN regexp_matches(x, '^-*[0-9]+\\.0$') THEN bare ELSE x END AS token,
    coalesce(lower(x) IN ('0','other','unclassified','none','na','nan',''), true) AS special,
    coalesce(regexp_extract(v, '(?i)taxid:([0-9]+)', 1), '') AS truth,
    coalesce(nullif(regexp_extract(v, 'taxid:(\\d+)', 1), ''), string_split(v, '_')[1]) AS source FROM t"""
)
def label_algebra(spark, d):
    texts = I.shared(spark, d, "WITH " + _TEXTS + " SELECT * FROM texts")
    v = F.col("v")
    return texts.select("c_custkey", L.canonical_label(v).alias("canonical"), L.combiner_label(v).alias("combiner"), L.display_token(v).alias("token"), L.is_special(v).alias("special"), L.true_label(v).alias("truth"), L.source_of_read(v).alias("source"))


@query(
    """WITH k AS (SELECT *, CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'Other' WHEN 2 THEN NULL WHEN 3 THEN 'unclassified' ELSE c_custkey::varchar END AS label,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat(c_name, c_mktsegment) END AS n FROM customer),
    s AS (SELECT *, CASE WHEN lower(trim(label)) = 'other' THEN 'other' WHEN label IS NULL OR label IN ('0', 'unclassified') THEN '0' ELSE coalesce(n, label) END AS s FROM k)
    SELECT c_custkey, CASE WHEN length(s) > 12 THEN substr(s, 1, 11) || '…' ELSE s END AS shown, regexp_replace(concat_ws(' ', c_name, c_mktsegment), '[^A-Za-z0-9._-]+', '_', 'g') AS safe FROM s"""
)
def label_display(spark, d):
    c = I.table(spark, d, "customer")
    kind = F.col("c_custkey") % 5
    label = F.when(kind == 0, "0").when(kind == 1, "Other").when(kind == 3, "unclassified").when(kind == 4, F.col("c_custkey").cast("string"))
    name = F.when(F.col("c_custkey") % 7 != 0, F.concat("c_name", "c_mktsegment"))
    return c.select("c_custkey", L.display_label(label, name, 12).alias("shown"), L.safe_id(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("safe"))


@query(
    f"""WITH {_CALLS} SELECT "taxID_a_0"::double AS "taxID_a_0", "taxID_b_0"::double AS "taxID_b_0", "taxID_c_0"::double AS "taxID_c_0", length::int AS length, "true"::double AS "true", l_orderkey::bigint AS l_orderkey, l_linenumber::bigint AS l_linenumber FROM calls"""
)
def model_input(spark, d):
    rows = L.model_input(I.calls(spark, d).select("sample", "seq", *I.ANNOTATORS, "length", "true", "l_orderkey", "l_linenumber"))
    return rows.withColumns({c: F.col(c).cast("long") for c in ("l_orderkey", "l_linenumber")})


_VOTED = """CASE WHEN "taxID_a_0" = '0' AND "taxID_b_0" = '0' AND "taxID_c_0" = '0' THEN true ELSE false END"""


@query(
    f"""WITH {_CALLS}, v AS (SELECT *, list_filter([a::bigint, b::bigint, c::bigint], lambda x: x > 0) AS votes FROM (SELECT *, "taxID_a_0" AS a, "taxID_b_0" AS b, "taxID_c_0" AS c FROM calls))
    SELECT seq, CASE WHEN len(votes) = 0 THEN '0' WHEN list_min(votes) = list_max(votes) THEN cast(list_max(votes) AS varchar) ELSE a END AS corrected,
    CASE WHEN len(votes) = 0 THEN 0.0 WHEN list_min(votes) = list_max(votes) AND len(votes) >= 2 THEN 1.0 ELSE confidence END AS confidence FROM v"""
)
def consensus_override(spark, d):
    rows, label, sure = reprofile.consensus(I.calls(spark, d), I.ANNOTATORS, F.col("taxID_a_0"), F.col("confidence"))
    none = L.all_unclassified(I.ANNOTATORS)
    return rows.select("seq", F.when(none, "0").otherwise(label).alias("corrected"), F.when(none, 0.0).otherwise(sure).alias("confidence"))


# taxonomy -------------------------------------------------------------------


def _genus_map(spark, d):
    return taxonomy.ancestor_at_rank(I.nodes(spark, d), "genus").select(F.col("tax_id").cast("string").alias("taxid"), F.col("ancestor").cast("string").alias("mapped"))


_UP = """up(tax_id, anc, depth) AS (SELECT tax_id, tax_id, 0 FROM nodes UNION ALL SELECT u.tax_id, n.parent, u.depth + 1 FROM up u JOIN nodes n ON u.anc = n.tax_id WHERE n.parent <> n.tax_id)"""


@query(f"WITH RECURSIVE {_NODES}, {_UP} SELECT u.tax_id, arg_min(u.anc, u.depth) AS ancestor FROM up u JOIN nodes n ON u.anc = n.tax_id WHERE n.rank = 'genus' GROUP BY u.tax_id")
def ancestor_at_rank(spark, d):
    return taxonomy.ancestor_at_rank(I.nodes(spark, d), "genus")


@query(
    f"""WITH RECURSIVE {_NODES}, {_UP}
    SELECT u.tax_id, max(CASE WHEN rank = 'species' THEN anc END) AS species, max(CASE WHEN rank = 'genus' THEN anc END) AS genus FROM up u JOIN nodes n ON u.anc = n.tax_id WHERE n.tax_id <> 1 GROUP BY u.tax_id"""
)
def lineages(spark, d):
    nodes = I.nodes(spark, d)
    return taxonomy.lineage(nodes, nodes).select("tax_id", F.try_element_at("lineage", F.lit("species")).alias("species"), F.try_element_at("lineage", F.lit("genus")).alias("genus"))


_ROLL = """CASE WHEN label = '0' THEN {none} ELSE (SELECT cast(10 + n_regionkey AS varchar) FROM nation WHERE cast(100 + n_nationkey AS varchar) = label) END"""


@query(f"WITH {_VOTES} SELECT annotator, sample, {_ROLL.format(none="'0'")} AS label, count(*) AS n FROM votes GROUP BY ALL")
def roll_up_to_genus(spark, d):
    counts = I.votes(spark, d).groupBy("annotator", "sample", "label").agg(F.count(F.lit(1)).alias("n"))
    return taxonomy.roll_up(counts, _genus_map(spark, d)).groupBy("annotator", "sample", "label").agg(F.sum("n").alias("n"))


@query(f"""WITH {_VOTES} SELECT 'genus' AS rank, annotator, {_ROLL.format(none='NULL')} AS label, count(*) AS n FROM votes GROUP BY ALL UNION ALL SELECT 'species', annotator, nullif(label, '0'), count(*) FROM votes GROUP BY ALL""")
def votes_at_ranks(spark, d):
    counts = I.votes(spark, d).groupBy("annotator", "label").agg(F.count(F.lit(1)).alias("n"))
    out = taxonomy.expand_ranks(counts, I.nodes(spark, d), ["genus", "species"])
    return out.groupBy("rank", "annotator", "label").agg(F.sum("n").alias("n"))


@query(f"WITH {_VOTES} SELECT DISTINCT label AS taxid, coalesce(n_name, r_name, label) AS name FROM votes LEFT JOIN nation ON cast(100 + n_nationkey AS varchar) = label LEFT JOIN region ON cast(10 + r_regionkey AS varchar) = label")
def label_names(spark, d):
    nation = I.table(spark, d, "nation").select((F.col("n_nationkey") + 100).cast("string").alias("taxid"), F.col("n_name").alias("name"))
    region = I.table(spark, d, "region").select((F.col("r_regionkey") + 10).cast("string").alias("taxid"), F.col("r_name").alias("name"))
    return taxonomy.label_names(I.votes(spark, d).select(F.col("label").alias("taxid")), nation, region)


@query("SELECT cast(c_custkey AS varchar) || '|' || replace(c_name, '|', '/') AS value FROM customer WHERE c_custkey <> 0")
def name_map_lines(spark, d):
    names = I.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("taxid"), F.col("c_name").alias("name"))
    return K.map_lines(names, "taxid", "name")


# abundance ------------------------------------------------------------------


@query(f"WITH {_ABUNDANCE} SELECT * FROM ab")
def abundance_counts(spark, d):
    return _abundance(spark, d)


@query(f"""WITH {_ABUNDANCE} SELECT annotator, sample, taxid, round_even(n::double / sum(n) OVER (PARTITION BY annotator, sample) * 5000.0, 0)::bigint AS n FROM ab""")
def abundance_rescaled(spark, d):
    return A.rescale_plain(_abundance(spark, d), 5000)


_EXACT = """s AS (SELECT *, round_even(n::double / sum(n) OVER (PARTITION BY annotator, sample) * 5003.0, 0)::bigint AS s FROM {src}),
    r AS (SELECT *, row_number() OVER (PARTITION BY annotator, sample ORDER BY s DESC, taxid) AS r, sum(s) OVER (PARTITION BY annotator, sample) AS a FROM s)"""


@query(f"WITH {_ABUNDANCE}, {_EXACT.format(src='ab')} SELECT annotator, sample, taxid, (s + CASE WHEN r = 1 THEN 5003 - a ELSE 0 END)::bigint AS n FROM r")
def abundance_scaled_exactly(spark, d):
    return A.scale_exact(_abundance(spark, d), 5003)


_KEPT = """f AS (SELECT *, n::double / sum(n) OVER (PARTITION BY annotator, sample) AS f FROM ab), m AS (SELECT *, max(f) OVER (PARTITION BY annotator, taxid) AS m FROM f), kept AS (SELECT annotator, sample, taxid, n FROM m WHERE m >= 0.041)"""


@query(f"WITH {_ABUNDANCE}, {_KEPT} SELECT * FROM kept")
def abundance_filtered(spark, d):
    return A.filter_labels(_abundance(spark, d), 0.041)


@query(f"WITH {_ABUNDANCE}, {_KEPT}, {_EXACT.format(src='kept')} SELECT annotator, sample, taxid, n FROM (SELECT annotator, sample, taxid, (s + CASE WHEN r = 1 THEN 5003 - a ELSE 0 END)::bigint AS n FROM (SELECT * FROM r))")
def profile_direct(spark, d):
    kept = A.filter_labels(A.complete(_abundance(spark, d)), 0.041)
    return synth.finish(kept, 5003, True)


@query(f"""WITH {_ABUNDANCE} SELECT sample, taxid, sum(CASE WHEN annotator = 'taxID_a_0' THEN n ELSE 0 END)::bigint AS "N_taxID_a_0", sum(CASE WHEN annotator = 'taxID_b_0' THEN n ELSE 0 END)::bigint AS "N_taxID_b_0", sum(CASE WHEN annotator = 'taxID_c_0' THEN n ELSE 0 END)::bigint AS "N_taxID_c_0" FROM ab GROUP BY ALL""")
def abundance_by_sample(spark, d):
    return A.merge_tables(_abundance(spark, d), list(I.ANNOTATORS))


@query(f"WITH {_ABUNDANCE} SELECT taxid, sum(n)::bigint AS n FROM ab GROUP BY ALL")
def abundance_totals(spark, d):
    return A.label_totals(_abundance(spark, d))


@query(f"WITH {_ABUNDANCE}, {_GENOMES} SELECT taxid, sum(n)::bigint AS n FROM ab WHERE taxid IN (SELECT taxid FROM genomes) GROUP BY ALL ORDER BY n DESC, taxid LIMIT 7")
def abundance_top_available(spark, d):
    return A.top_available(_abundance(spark, d), _genomes(spark, d), 7)


_PAIRS = """e AS (SELECT cast(user_id % 12 AS varchar) AS sample, event_type AS taxid, count(*) AS n FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL),
    g AS (SELECT t.taxid, s.sample, coalesce(e.n, 0)::double AS n FROM (SELECT DISTINCT taxid FROM e) t CROSS JOIN (SELECT DISTINCT sample FROM e) s LEFT JOIN e ON e.taxid = t.taxid AND e.sample = s.sample),
    p AS (SELECT x.taxid AS a, y.taxid AS b, x.n AS x, y.n AS y FROM g x JOIN g y ON x.sample = y.sample AND x.taxid <> y.taxid)"""


@query(
    f"""WITH {_PAIRS} SELECT 'events' AS annotator, a, b, round(sum(CASE WHEN x > 0 AND y > 0 THEN 1 ELSE 0 END)::double / sum(CASE WHEN x > 0 THEN 1 ELSE 0 END), 6) AS prob, sum(CASE WHEN x > 0 AND y > 0 THEN 1 ELSE 0 END)::bigint AS n_shared,
    round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(greatest(regr_r2(y, x), 1e-5), 6) AS r2, round(corr(ln(1 + x), ln(1 + y)), 6) AS corr FROM p GROUP BY a, b"""
)
def pair_statistics(spark, d):
    out = A.pair_statistics(I.events_abundance(spark, d))
    return out.select("annotator", "a", "b", "n_shared", *(F.round(c, 6).alias(c) for c in ("prob", "slope", "intercept", "r2", "corr")))


# allocation -----------------------------------------------------------------


@query(f"WITH {_ABUNDANCE}, {_GENOMES}, u AS (SELECT * FROM ab WHERE taxid IN (SELECT taxid FROM genomes)), s AS (SELECT annotator, sample, taxid AS source, floor(n::double / sum(n) OVER (PARTITION BY annotator, sample) * 2000)::bigint AS n FROM u) SELECT * FROM s WHERE n > 0")
def read_plan(spark, d):
    return allocate.read_plan(_abundance(spark, d), _genomes(spark, d), 2000)


@query(f"WITH {_ABUNDANCE}, {_GENOMES}, u AS (SELECT * FROM ab WHERE taxid IN (SELECT taxid FROM genomes)), s AS (SELECT annotator, taxid AS source, floor(n::double / sum(n) OVER (PARTITION BY annotator, sample) * 2000)::bigint AS n FROM u) SELECT annotator, source, sum(n)::bigint AS n FROM s WHERE n > 0 GROUP BY ALL")
def read_plan_totals(spark, d):
    return allocate.plan_totals(allocate.read_plan(_abundance(spark, d), _genomes(spark, d), 2000))


#: Requests: how many orders of each nation each segment asks for; the pool: all orders of that nation.
_ASK = """ask AS (SELECT cast(c_nationkey AS varchar(20)) AS source, c_mktsegment AS sample, count(*) AS req FROM {customer} WHERE c_custkey % 3 = 0 GROUP BY c_nationkey, c_mktsegment)"""
_POOL = """pool AS (SELECT cast(c_nationkey AS varchar(20)) AS source, o_orderkey AS item FROM {orders} JOIN {customer} ON o_custkey = c_custkey)"""
_SHARES = """av AS (SELECT source, count(*) AS avail FROM pool GROUP BY ALL), sm AS (SELECT sample, row_number() OVER (ORDER BY sample) AS pos FROM (SELECT DISTINCT sample FROM ask)),
    g AS (SELECT av.source, avail, sample, pos, coalesce(req, 0) AS req FROM av CROSS JOIN sm LEFT JOIN ask USING (source, sample)),
    t AS (SELECT *, sum(req) OVER (PARTITION BY source) AS tot, count(*) OVER (PARTITION BY source) AS m, row_number() OVER (PARTITION BY source ORDER BY pos) AS i FROM g),
    w AS (SELECT *, CASE WHEN tot > 0 THEN round_even(req::double / tot * avail, 0)::bigint ELSE avail // m + (i <= avail % m)::bigint END AS w FROM t),
    l AS (SELECT *, CASE WHEN tot > 0 AND i = m THEN avail ELSE least(sum(w) OVER (PARTITION BY source ORDER BY pos), avail) END::bigint AS last FROM w),
    shares AS (SELECT source, sample, last, coalesce(lag(last) OVER (PARTITION BY source ORDER BY pos), 0) AS before FROM l)"""


def _requests(spark, d):
    ask = I.shared(spark, d, "WITH " + _ASK + " SELECT * FROM ask")
    order = ask.select("sample").distinct().withColumn("pos", F.row_number().over(Window.orderBy("sample")))
    return ask.join(order, "sample")


@query(f"WITH {I.duck(_ASK)}, {I.duck(_POOL)}, {_SHARES} SELECT source, sample, (last - before)::bigint AS n FROM shares WHERE last > before")
def split_by_source_counts(spark, d):
    pool = I.shared(spark, d, "WITH " + _POOL + " SELECT * FROM pool")
    return allocate.split_pool(pool, _requests(spark, d), ["source"], ["item"]).groupBy("source", "sample").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {I.duck(_ASK)}, {I.duck(_POOL)}, {_SHARES}, nb AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY item) AS rn FROM pool) SELECT nb.source, item, sample FROM nb JOIN shares s ON nb.source = s.source AND rn > before AND rn <= last")
def split_by_source(spark, d):
    pool = I.shared(spark, d, "WITH " + _POOL + " SELECT * FROM pool")
    return allocate.split_pool(pool, _requests(spark, d), ["source"], ["item"]).select("source", "item", "sample")


@query(
    f"""WITH {_GENOMES}, {_ABUNDANCE}, g AS (SELECT taxid, row_number() OVER (ORDER BY taxid) - 1 AS k, count(*) OVER () AS m FROM (SELECT DISTINCT taxid FROM ab WHERE taxid IN (SELECT taxid FROM genomes))),
    s AS (SELECT 'sample' || i AS sample, (('0x' || substr(md5(i || '/42'), 1, 12))::bigint % 1001)::bigint AS host FROM range(1, 11) t(i))
    SELECT sample, 'host' AS source, host AS n FROM s UNION ALL SELECT sample, taxid, ((1000 - host) // m + CASE WHEN k < (1000 - host) % m THEN 1 ELSE 0 END)::bigint FROM s, g"""
)
def sample_design(spark, d):
    seen = A.available_labels(_abundance(spark, d), _genomes(spark, d))
    return allocate.sample_design(spark, 10, 1000, seen.select("taxid"))


# sequences ------------------------------------------------------------------


@query(
    f"""WITH {_LETTERS}, n AS (SELECT *, length(seq) AS len, length(seq) - length(replace(seq, 'G', '')) AS g, length(seq) - length(replace(seq, 'C', '')) AS c, length(seq) - length(replace(seq, 'A', '')) AS a, length(seq) - length(replace(seq, 'T', '')) AS t,
    list_transform(list_distinct(string_split(seq, '')), lambda x: (length(seq) - length(replace(seq, x, '')))::double / length(seq)) AS p FROM letters WHERE seq <> '')
    SELECT read_id, len::int AS length, round((g + c)::double / len, 6) AS gc, round((g - c) / (g + c + 1e-12), 6) AS gc_skew, round((a - t) / (a + t + 1e-12), 6) AS at_skew,
    round(list_sum(list_transform(p, lambda x: -x * log2(x + 1e-12))), 6) AS shannon, round(-log2(list_sum(list_transform(p, lambda x: x * x)) + 1e-12), 6) AS renyi2, round(-log2(list_max(p) + 1e-12), 6) AS min_entropy FROM n"""
)
def read_features(spark, d):
    reads = I.letters(spark, d).where("seq <> ''")
    out = sequences.read_features(reads)
    return out.select("read_id", "length", *(F.round(c, 6).alias(c) for c in ("gc", "gc_skew", "at_skew", "shannon", "renyi2", "min_entropy")))


@query(
    f"""WITH {_LETTERS}, k AS (SELECT read_id, length(seq) AS len, list_transform(range(1, greatest(length(seq) - 1, 1)), lambda i: substr(seq, i, 3)) AS w, list_transform(range(1, greatest(length(seq) - 8, 1)), lambda i: substr(seq, i, 10)) AS v, seq FROM letters WHERE seq <> '')
    SELECT read_id, CASE WHEN len < 3 THEN 0.0 ELSE round(len(list_distinct(w))::double / least(64, len - 2), 6) END AS ling_complexity,
    CASE WHEN len < 10 THEN 0.0 ELSE round(len(list_filter(v, lambda x: len(list_distinct(string_split(x, ''))) < 5))::double / len(v), 6) END AS repeat_frac,
    round(coalesce(list_sum(list_transform(w, lambda x: CASE WHEN x[1] = x[2] AND x[2] = x[3] THEN 6 WHEN x[1] = x[2] OR x[2] = x[3] OR x[1] = x[3] THEN 2 ELSE 0 END)), 0)::double / len, 6) AS dust FROM k"""
)
def read_complexity(spark, d):
    reads = I.letters(spark, d).where("seq <> ''")
    s = F.col("seq")
    return reads.select("read_id", F.round(S.linguistic_complexity(s), 6).alias("ling_complexity"), F.round(S.repeat_fraction(s), 6).alias("repeat_frac"), F.round(S.dust_score(s), 6).alias("dust"))


@query(f"WITH {_LETTERS} SELECT read_id, round(list_avg(list_transform(string_split(seq, ''), lambda x: ascii(x) - 33)), 6) AS mean_qual FROM letters WHERE seq <> ''")
def read_quality(spark, d):
    return I.letters(spark, d).where("seq <> ''").select("read_id", F.round(S.mean_quality(F.col("qual")), 6).alias("mean_qual"))


@query(
    f"""WITH {_CONTIGS}, k AS (SELECT header, unnest(list_transform(range(1, greatest(length(sequence) - 1, 1)), lambda i: substr(sequence, i, 3))) AS kmer FROM contigs WHERE length(sequence) >= 3)
    SELECT kmer, count(*) AS n, count(DISTINCT header) AS reads FROM k WHERE regexp_full_match(kmer, '[ACGT]+') GROUP BY ALL"""
)
def kmer_counts(spark, d):
    counts = I.contigs(spark, d).select(F.posexplode(S.kmer_counts(F.col("sequence"), 3)).alias("at", "n")).where("n > 0")
    names = F.array(*map(F.lit, S.kmer_vocabulary(3)))
    return counts.groupBy(F.get(names, F.col("at")).alias("kmer")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("reads"))


@query(
    f"""WITH {_CONTIGS}, p AS (SELECT *, CASE WHEN floor(length(sequence) * 30.0 / 100) > 0 THEN floor(length(sequence) * 30.0 / 100)::bigint ELSE greatest(length(sequence), 1) END AS step FROM contigs),
    e AS (SELECT *, unnest(range(0, length(sequence), step)) AS ofs FROM p)
    SELECT concat_ws('|', taxid, 'taxid:' || taxid, contig_no, ofs // step) AS header, md5(substr(sequence, ofs + 1, step)) AS sequence_md5, length(substr(sequence, ofs + 1, step))::int AS length FROM e"""
)
def contig_parts(spark, d):
    return sequences.split_contigs(I.contigs(spark, d), 30.0).select("header", F.md5("sequence").alias("sequence_md5"), F.length("sequence").alias("length"))


_CODONS = "MAP {" + ", ".join(f"'{a}{b}{c}': '{S.GENETIC_CODE[16 * i + 4 * j + k]}'" for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")) + "}"
_FRAMES = _CONTIGS + f""", st AS (SELECT file, taxid, contig_no, 1 AS strand, sequence AS s FROM contigs UNION ALL SELECT file, taxid, contig_no, -1, reverse(translate(sequence, 'ACGT', 'TGCA')) FROM contigs),
    fr AS (SELECT file, taxid, contig_no, strand, f AS frame, substr(s, f + 1) AS s FROM st, (VALUES (0), (1), (2)) v(f)),
    aa AS (SELECT file, taxid, contig_no, strand, frame, coalesce(array_to_string(list_transform(range(0, length(s) // 3), lambda i: coalesce({_CODONS}[substr(s, i * 3 + 1, 3)], 'X')), ''), '') AS aa FROM fr)"""


@query(f"WITH {_FRAMES} SELECT file, 'c' || contig_no || 's' || strand || 'f' || frame AS id, md5(replace(aa, '*', 'X')) AS aa_md5, length(aa)::int AS length FROM aa")
def six_frames(spark, d):
    return sequences.six_frames(I.contigs(spark, d)).select("file", "id", F.md5("aa").alias("aa_md5"), F.length("aa").alias("length"))


@query(
    f"""WITH {_FRAMES}, sp AS (SELECT *, unnest(string_split(aa, '*')) AS raw, generate_subscripts(string_split(aa, '*'), 1) AS k FROM aa), ok AS (SELECT *, replace(raw, 'X', '') AS orf FROM sp WHERE length(replace(raw, 'X', '')) >= 15)
    SELECT file, (row_number() OVER (PARTITION BY file ORDER BY contig_no, strand DESC, frame, k) - 1)::int AS orf_no, orf AS aa FROM ok"""
)
def open_reading_frames(spark, d):
    return sequences.open_reading_frames(I.contigs(spark, d)).select("file", "orf_no", "aa")


@query(f"WITH {_CONTIGS} SELECT taxid, 'taxid:' || taxid AS header, md5(string_agg(sequence, repeat('N', 500) ORDER BY contig_no)) AS sequence_md5 FROM contigs GROUP BY taxid")
def genome_records(spark, d):
    return sequences.join_contigs(I.contigs(spark, d)).select("taxid", "header", F.md5("sequence").alias("sequence_md5"))


@query(f"WITH {_CONTIGS} SELECT file, contig_no, 'seq' || (row_number() OVER (PARTITION BY file ORDER BY contig_no) - 1) || '|kraken:taxid|' || taxid AS header FROM contigs")
def library_headers(spark, d):
    return sequences.number_records(I.contigs(spark, d), "file", "contig_no", F.col("taxid")).select("file", "contig_no", "header")


@query(f"WITH {_CONTIGS} SELECT '>' || header || chr(10) || sequence AS value FROM contigs")
def fasta_lines(spark, d):
    return K.fasta_lines(I.contigs(spark, d))


_DRAW = "('0x' || substr(md5({header} || '/42/' || {k}), {at}, 8))::bigint"
_JUMP = "1 + floor(ln((" + _DRAW + " + 0.5) / 4294967296) / ln(1 - 0.02))::bigint"


@query(
    f"""WITH RECURSIVE {_CONTIGS}, hit AS (SELECT header, sequence, 0::bigint AS k, 0::bigint AS before, {_JUMP.format(header='header', k=0, at=1)} AS spot FROM contigs
        UNION ALL SELECT header, sequence, k + 1, spot, spot + {_JUMP.format(header='header', k='(k + 1)', at=1)} FROM hit WHERE spot <= length(sequence)),
    new AS (SELECT *, replace('ACGT', substr(sequence, spot, 1), '') AS others FROM hit WHERE spot <= length(sequence)),
    part AS (SELECT header, k, spot, substr(sequence, before + 1, spot - before - 1) || substr(others, ({_DRAW.format(header='header', k='k', at=9)} % length(others) + 1)::int, 1) AS p FROM new),
    all_parts AS (SELECT header, string_agg(p, '' ORDER BY k) AS p, max(spot) AS last FROM part GROUP BY header)
    SELECT c.header, md5(coalesce(p, '') || substr(sequence, coalesce(last, 0) + 1)) AS sequence_md5 FROM contigs c LEFT JOIN all_parts a ON a.header = c.header"""
)
def mutated_sequences(spark, d):
    return sequences.mutate_sequences(I.contigs(spark, d), 0.02).select("header", F.md5("sequence").alias("sequence_md5"))


class _Pieces:
    """An emitter that numbers the pieces of all rows of its partition."""

    def __init__(self):
        self.n = self.letters = 0

    def rows(self, row):
        for at in range(0, len(row["sequence"]), 1000):
            piece = row["sequence"][at : at + 1000]
            self.n, self.letters = self.n + 1, self.letters + len(piece)
            yield row["header"], self.n, len(piece)

    def finish(self):
        yield None, self.n + 1, self.letters


@query(
    f"""WITH {_CONTIGS}, p AS (SELECT file, header, contig_no, ofs, length(substr(sequence, ofs + 1, 1000)) AS length FROM (SELECT *, unnest(range(0, length(sequence), 1000)) AS ofs FROM contigs))
    SELECT file, header, row_number() OVER (PARTITION BY file ORDER BY contig_no, ofs)::bigint AS piece, length::bigint AS length FROM p UNION ALL SELECT file, NULL, count(*) + 1, sum(length)::bigint FROM p GROUP BY file"""
)
def emitted_pieces(spark, d):
    """A user's stateful emitter as a table function over partitions."""
    registry.register_emitter(spark, "contig_pieces", _Pieces, "header string, piece bigint, length bigint")
    return spark.sql("SELECT file, header, piece, length FROM contig_pieces(TABLE(SELECT * FROM {contigs}) PARTITION BY file ORDER BY (contig_no), 'file')", contigs=I.contigs(spark, d))


@query("SELECT doc_id::varchar AS read_id, row_number() OVER (ORDER BY doc_id::varchar) AS place FROM documents")
def sorted_reads(spark, d):
    reads = I.letters(spark, d).withColumn("mate", F.lit(1))
    ordered = seqio.sort_reads(reads).select("read_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    return ordered.withColumn("i", inside).join(before, "part").select("read_id", (F.col("i") + F.col("b")).alias("place"))


@query("SELECT taxid, max(path) FILTER (WHERE r = 1) AS path FROM (SELECT *, row_number() OVER (PARTITION BY taxid ORDER BY path LIKE '%.faa', path) AS r FROM (SELECT cast(p_size AS varchar) AS taxid, '/g/' || p_partkey || '/' || p_size || CASE WHEN p_partkey % 3 = 0 THEN '.fna' ELSE '.faa' END AS path FROM part)) GROUP BY taxid")
def genome_catalogue(spark, d):
    ending = F.when(F.col("p_partkey") % 3 == 0, ".fna").otherwise(".faa")
    files = I.table(spark, d, "part").select(F.concat(F.lit("/g/"), F.col("p_partkey").cast("string"), F.lit("/"), F.col("p_size").cast("string"), ending).alias("path"))
    return T.one_file_per_label(T.catalogue_genomes(files)).select("taxid", "path")


# models and synthetic profiles ---------------------------------------------


@query()
def reprofiled(spark, d):
    rows = materialize(I.calls(spark, d).select("sample", "seq", *I.ANNOTATORS, "length", "true"))  # learnt from, scored and corrected
    model = reprofile.train(rows)
    return reprofile.apply_reprofiler(rows, model).select("sample", "seq", "corrected", "corrected_confidence")


@query()
def composition_clusters(spark, d):
    profiles = materialize(features.kmer_profiles(I.contigs(spark, d).select(F.col("header").alias("read_id"), F.col("sequence").alias("seq"))).drop("seq"))  # every step of the fit reads them
    model = features.fit_composition(profiles)
    return features.composition_features(model, profiles).drop("seq")


@query()
def composition_classes(spark, d):
    rows = I.letters(spark, d).select("read_id", "lang", F.translate("seq", *I.BASES).alias("seq")).where("lang IS NOT NULL")
    profiles = materialize(features.kmer_profiles(rows).drop("seq"))  # every step of the fit reads them
    return features.classify_composition(features.fit_composition_classifier(profiles, "lang"), profiles).select("read_id", "pred", "confidence")


@query()
def profile_bootstrap(spark, d):
    return synth.regenerate(_abundance(spark, d), "bootstrap", n_samples=7)


@query(f"WITH {_ABUNDANCE} SELECT annotator, sample, sum(n)::double AS total, 0::bigint AS strangers FROM ab GROUP BY ALL")
def profile_bootstrap_totals(spark, d):
    """Bootstrapped samples keep their source's number of reads and take no label that it lacks."""
    known = _abundance(spark, d)
    drawn = synth.regenerate(known, "bootstrap", threshold=0.0)
    strange = drawn.join(known.select("annotator", "taxid", F.lit(1).alias("known")).distinct(), ["annotator", "taxid"], "left")
    return strange.groupBy("annotator", "sample").agg(F.sum(F.col("n").cast("double")).alias("total"), F.sum(F.col("known").isNull().cast("long")).alias("strangers"))


@query("""WITH s AS (SELECT DISTINCT (user_id % 12)::varchar AS sample FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL), m(mode) AS (VALUES ('vae'), ('glm'))
    SELECT mode, sample || CASE WHEN turn = 1 THEN '' ELSE '_r' || turn END AS sample, 1000::double AS total FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY turn, sample) AS place FROM m, s, (VALUES (1), (2)) t(turn)) WHERE place <= 15""")
def profile_scaled_totals(spark, d):
    """Synthetic samples of both models have their names and exactly the reads that were asked for."""
    known = I.events_abundance(spark, d)
    out = None
    for mode in ("vae", "glm"):
        got = synth.regenerate(known, mode, n_samples=15, n_reads=1000, rescale=True).groupBy(F.lit(mode).alias("mode"), "sample").agg(F.sum(F.col("n").cast("double")).alias("total"))
        out = got if out is None else out.unionByName(got)
    return out


@query(f"WITH {_CV}, u AS (SELECT a AS label FROM cv UNION SELECT b FROM cv) SELECT count(*)::bigint AS labels, count(*)::bigint AS places, (count(*) - 1)::bigint AS span FROM u")
def label_order_places(spark, d):
    """Every label has a place of its own, without gaps."""
    order = label_order(spark, d)
    return order.agg(F.countDistinct("label").alias("labels"), F.countDistinct("place").alias("places"), (F.max("place") - F.min("place")).cast("long").alias("span"))


@query()
def profile_vae(spark, d):
    return synth.regenerate(I.events_abundance(spark, d), "vae", n_samples=15, n_reads=1000, rescale=True)


@query()
def profile_glm(spark, d):
    return synth.regenerate(I.events_abundance(spark, d), "glm", n_samples=15, n_reads=1000, rescale=True)
