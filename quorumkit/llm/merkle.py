"""Merkle manifest of a dataset: a digest and a proof for every row, up to one root.

Nodes of a group lie in order; runs of sixteen make their parent. Siblings come
from windows: fixed-offset lag and lead columns, masked by a node's slot in its
run and by the run's length, and the first child of a run hashes the parent.
Blocks of 256 leaves are dealt out whole, so two levels need one shuffle and a
group of any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.operators.ranking import running_sum

from .common import materialize

#: Children of a node, and nodes that are dealt out together: the grandchildren of one node.
FANOUT = 16
BLOCK = FANOUT * FANOUT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many crc32 values of the decimal doc_id, a row is tampered with.
TAMPER_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of fields: '-' for a null, else the bytes' number, ':' and the value as text."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def _level(rows: DataFrame, node: Column, stride: int) -> tuple[DataFrame, Column, Column, Column]:
    """(rows, left, right, parent) for the nodes that stand ``stride`` leaves apart.

    left and right are the joined digests of a node's siblings, null on rows
    that are no node of this level; parent is there on the first child alone.
    """
    by = Window.partitionBy("key", "block").orderBy("pos")
    place = F.floor(F.col("pos") / stride)
    slot, wide = place % FANOUT, F.ceil(F.col("width") / stride)
    run = F.least(F.lit(FANOUT), wide - (place - slot))
    rows = rows.withColumns({f"lag{i}": F.when(slot >= i, F.lag(node, i * stride).over(by)) for i in range(1, FANOUT)} | {f"lead{i}": F.when(slot + i < run, F.lead(node, i * stride).over(by)) for i in range(1, FANOUT)})
    here = (F.col("pos") % stride == 0) & (wide > 1)
    left = F.when(here, F.concat_ws("", *(F.col(f"lag{i}") for i in range(FANOUT - 1, 0, -1))))
    right = F.when(here, F.concat_ws("", *(F.col(f"lead{i}") for i in range(1, FANOUT))))
    parent = F.when(here & (F.col("pos") % (stride * FANOUT) == 0), F.sha2(F.concat(node, right), 256))
    return rows, left, right, parent


def _both_levels(nodes: DataFrame) -> DataFrame:
    """Add siblings (left1, right1) of every node, those of its parent (left2, right2, on first children), and ``top``, the block's node (on the block's first row).

    A level that has one node already is left alone: its siblings are null and the node stays.
    """
    rows = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
    keep = [*rows.columns]
    rows, left, right, parent = _level(rows, F.col("digest"), 1)
    rows = rows.select(*keep, left.alias("left1"), right.alias("right1"), F.coalesce(parent, F.when(F.col("width") == 1, F.col("digest"))).alias("up"))
    keep = [*rows.columns]
    rows, left, right, parent = _level(rows, F.col("up"), FANOUT)
    return rows.select(*keep, left.alias("left2"), right.alias("right2"), F.when(F.col("pos") % BLOCK == 0, F.coalesce(parent, F.col("up"))).alias("top"))


def _rise(nodes: DataFrame) -> DataFrame:
    """The nodes two levels up."""
    tops = _both_levels(nodes).where(F.col("pos") % BLOCK == 0)
    return tops.select("key", F.col("block").alias("pos"), F.ceil(F.col("width") / BLOCK).alias("width"), F.col("top").alias("digest"))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes (key, pos, width, digest), each two levels above the one before; the last has one node for each key."""
    out = [nodes]
    while (out[-1].agg(F.max("width")).first()[0] or 1) > 1:
        out.append(materialize(_rise(out[-1].select("key", "pos", "width", "digest"))))
    return out


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Columns of the lowest level with ``path``, the siblings of each level from below, and the columns that ``tops`` (key, path, ...) has for each key."""
    more = [c for c in tops.columns if c not in ("key", "path")]
    known = tops.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(levels[:-1]):
        extra = [c for c in nodes.columns if c not in ("key", "pos", "width", "digest")]
        above = known.select("key", F.col("pos").alias("block"), F.col("path").alias("above"), *more)
        joined = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(above, ["key", "block"])
        rows = _both_levels(joined)
        run = Window.partitionBy("key", "block", F.floor(F.col("pos") / FANOUT))
        parents = F.max(F.when(F.col("left2").isNotNull(), F.struct(F.col("left2").alias("left"), F.col("right2").alias("right")))).over(run)
        own = F.when(F.col("left1").isNotNull(), F.struct(F.col("left1").alias("left"), F.col("right1").alias("right")))
        path = F.concat(F.array_compact(F.array(own, parents)), "above")
        known = rows.select("key", "pos", "digest", *extra, path.alias("path"), *more)
    return known


def _source_key(source: Column) -> Column:
    """A text that is never null and orders sources as the manifest does: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Leaves of a source go by doc_id (null first), those of equal ids by their
    digests; equal rows have equal leaves and a place each. A null source is a
    source of its own and stands first. folded_root is computed again from the
    leaf and its siblings, for tampered rows (never those without an id) from
    the leaf of the lower-cased text. Other columns do not count; no rows give
    no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0, F.lit(False))
    changed = leaf_digest(*fields[:-1], F.translate(fields[-1].cast("string"), _UPPER, _LOWER))
    leaves = materialize(docs.select(_source_key(F.col("source")).alias("key"), "doc_id", leaf_digest(*fields).alias("digest"), F.when(tampered, changed).alias("changed")))
    placed = running_sum(leaves, ["key"], ["doc_id", "digest"], name="pos")
    sources = leaves.groupBy("key").agg(F.count(F.lit(1)).alias("width"))
    # the number of leaves comes block by block, so that no source's rows meet in one task
    blocks = sources.select("key", "width", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / BLOCK))).alias("block"))
    nodes = placed.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(blocks, ["key", "block"]).drop("block")
    levels = _levels(nodes)
    subroots = levels[-1].where("pos = 0").select("key", F.col("digest").alias("subroot"))
    numbered = running_sum(subroots, [], ["key"], name="pos")
    n = sources.count()
    upper = _levels(materialize(numbered.select(F.lit("").alias("key"), "pos", F.lit(n).cast("long").alias("width"), F.col("subroot").alias("digest"), F.col("key").alias("source"), "subroot")))
    root = upper[-1].where("pos = 0").select("key", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    if len(upper) == 1:  # one source: its root is the whole root
        tops = upper[0].select(F.col("source").alias("key"), F.array().cast(_PATH).alias("path"), "subroot", F.col("digest").alias("root"))
    else:
        tops = _paths(upper, root).select(F.col("source").alias("key"), "path", "subroot", "root")
    if len(levels) == 1:  # every source has one leaf
        rows = nodes.join(tops, "key")
    else:
        rows = _paths(levels, materialize(tops))
    proof = F.sha2(F.aggregate("path", F.lit(""), lambda done, s: F.concat(done, s["left"], s["right"])), 256)
    folded = F.aggregate("path", F.coalesce("changed", "digest"), lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))
    out = rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of a text in DuckDB, bit by bit: each byte is mixed in, then shifted out eight times.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({x}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END))"""


def manifest_sql() -> str:
    """The manifest of ``documents`` in DuckDB's SQL, over rows whose doc_ids differ."""
    part = lambda v: f"coalesce(strlen({v}::varchar)::varchar || ':' || {v}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    path = lambda at: f"SELECT {at}.doc_id, {at}.lvl, coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (WHERE s.pos < {at}.pos), '') AS l, coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (WHERE s.pos > {at}.pos), '') AS r"
    return f"""WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('s' || source, 'n') AS key, {leaf('text')} AS d, CASE WHEN {_CRC.format(x="doc_id::varchar")} % {TAMPER_EVERY} = 0 THEN {leaf(lower)} END AS changed FROM documents),
    placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY key) AS width FROM leaves),
    tree AS (SELECT 0 AS lvl, key, pos, d, width FROM placed UNION ALL SELECT lvl + 1, key, pos // 16, sha256(string_agg(d, '' ORDER BY pos)), (width + 15) // 16 FROM tree WHERE width > 1 GROUP BY lvl, key, pos // 16, width),
    subs AS MATERIALIZED (SELECT key, d AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS width FROM tree WHERE width = 1),
    crown AS (SELECT 100 AS lvl, pos, subroot AS d, width FROM subs UNION ALL SELECT lvl + 1, pos // 16, sha256(string_agg(d, '' ORDER BY pos)), (width + 15) // 16 FROM crown WHERE width > 1 GROUP BY lvl, pos // 16, width),
    low AS (SELECT p.doc_id, t.lvl, p.key, t.pos FROM placed p JOIN tree t ON t.key = p.key AND t.pos = p.pos // (16 ** t.lvl)::bigint WHERE t.width > 1),
    high AS (SELECT p.doc_id, c.lvl, c.pos FROM placed p JOIN subs s ON s.key = p.key JOIN crown c ON c.pos = s.pos // (16 ** (c.lvl - 100))::bigint WHERE c.width > 1),
    steps AS MATERIALIZED ({path('low')} FROM low JOIN tree s ON s.lvl = low.lvl AND s.key = low.key AND s.pos // 16 = low.pos // 16 GROUP BY low.doc_id, low.lvl, low.pos
        UNION ALL {path('high')} FROM high JOIN crown s ON s.lvl = high.lvl AND s.pos // 16 = high.pos // 16 GROUP BY high.doc_id, high.lvl, high.pos),
    numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM steps),
    folds AS (SELECT doc_id, 0 AS i, coalesce(changed, d) AS d FROM placed UNION ALL SELECT f.doc_id, f.i + 1, sha256(s.l || f.d || s.r) FROM folds f JOIN numbered s ON s.doc_id = f.doc_id AND s.i = f.i + 1),
    done AS (SELECT doc_id, arg_max(d, i) AS folded_root FROM folds GROUP BY doc_id),
    proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY i)) AS proof FROM numbered GROUP BY doc_id)
    SELECT p.doc_id, p.d AS leaf, s.subroot, c.d AS root, coalesce(f.proof, sha256('')) AS proof_sha256, folded_root, folded_root = c.d AS verified
    FROM placed p JOIN subs s ON s.key = p.key JOIN done ON done.doc_id = p.doc_id LEFT JOIN proofs f ON f.doc_id = p.doc_id CROSS JOIN (SELECT d FROM crown WHERE width = 1) c"""
