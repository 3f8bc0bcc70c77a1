"""Licence scans with DataFrame functions only.

Headers (sentences that speak of a licence) and whole texts are compared with
licence templates by the cosine of sparse TF-IDF vectors. A text that as a
whole is a licence governs its directory, and files without a licence of their
own inherit that of the nearest directory above them.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: Short notices by which licences are declared.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: A sentence is a header if it holds one of these.
SIGNALS = r"licen[sc]|copyright|public domain|\bcc0\b|all rights reserved"
HEADER_COSINE, FILE_COSINE = 0.75, 0.6
#: A whole text is a licence's full text or header block from here; long templates share their common words with any prose.
BODY_COSINE = 0.8
_WORD = "[a-z0-9]+"
_TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
_GNU_BLOCK = """This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version.
This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2}General Public License for more details.
You should have received a copy of the GNU {2}General Public License along with this {0}{4}"""
_LINK = ". If not, see <https://www.gnu.org/licenses/>."
_STREET = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
#: Header blocks of several lines.
BLOCKS: list[tuple[str, str]] = [
    ("AGPL-3.0", _GNU_BLOCK.format("program", ":", "Affero ", 3, _LINK)),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-2.0", _GNU_BLOCK.format("program", ";", "", 2, _STREET)),
    ("GPL-3.0", _GNU_BLOCK.format("program", ":", "", 3, _LINK)),
    ("LGPL-3.0", _GNU_BLOCK.format("library", ":", "Lesser ", 3, _LINK)),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]


@lru_cache
def bodies() -> tuple[tuple[str, str], ...]:
    """(license, text) of full licences and header blocks; a licence may have several.

    The Affero licence is that of the GPL under its own name, and the two-clause
    BSD licence that of three clauses without the third.
    """
    out = {}
    for name in sorted(os.listdir(_TEXTS)):
        with open(os.path.join(_TEXTS, name), encoding="utf-8") as f:
            out[name.removesuffix(".txt")] = f.read()
    out["AGPL-3.0"] = out["GPL-3.0"].replace("GNU General Public License", "GNU Affero General Public License")
    bsd = out["BSD-3-Clause"]
    out["BSD-2-Clause"] = bsd[: bsd.index("Neither the name")] + bsd[bsd.index("THIS SOFTWARE IS") :]
    return (*sorted(out.items()), *BLOCKS)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"), F.lit(1))


def template_terms(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(license, word, tf) of each template, whose names differ."""
    rows = F.array(*(F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in templates))
    texts = spark.range(1).select(F.explode(rows).alias("t")).select("t.license", F.explode(_words(F.col("t.text"))).alias("word"))
    return texts.groupBy("license", "word").agg(F.count(F.lit(1)).alias("tf"))


def inverse_frequencies(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, idf) of the templates' words over all texts: ln((1 + N) / (1 + n)) + 1."""
    seen = texts.select(F.array_intersect(F.split(F.lit(" ".join(vocabulary)), " "), F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " ")).alias("w"))
    counts = seen.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = texts.sparkSession.range(1).select(F.explode(F.split(F.lit(" ".join(vocabulary)), " ")).alias("word"))
    total = texts.count()
    return words.join(F.broadcast(counts), "word", "left").select("word", (F.log((1.0 + total) / (1.0 + F.coalesce("n", F.lit(0)))) + 1).alias("idf"))


def _best_template(units: DataFrame, terms: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """Best template of each unit (keys, text): license and cosine.

    Words of no template weigh 1. Only (unit, word) rows of texts with a signal
    are grouped; the template side is a few hundred rows.
    """
    words = units.select(*keys, F.explode(_words(F.col("text"))).alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("tf"))
    weighed = words.join(F.broadcast(idf), "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    wt = terms.join(idf, "word").select("license", "word", (F.col("tf") * F.col("idf")).alias("wt"))
    norms = wt.groupBy("license").agg(F.sqrt(F.sum(F.col("wt") * F.col("wt"))).alias("nt"))
    wt = wt.join(norms, "license")
    dots = F.broadcast(wt.groupBy("word").agg(F.collect_list(F.struct("license", (F.col("wt") / F.col("nt")).alias("x"))).alias("in")))
    joined = weighed.join(dots, "word", "left")
    norm = joined.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = joined.select(*keys, "w", F.explode("in").alias("i")).groupBy(*keys, F.col("i.license").alias("license")).agg(F.sum(F.col("w") * F.col("i.x")).alias("dot"))
    cosine = dot.join(norm, keys).select(*keys, "license", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
    best = F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license")))
    return cosine.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def ancestors(folder: Column) -> Column:
    """The folder and all folders above it, nearest first."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, t in templates for w in re.findall(_WORD, t.lower())})


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """file_key, folder, license, score, origin and from_folder of every file.

    files: file_key, folder ('a/b/c') and text. origin is 'own' for a header or
    a whole text above the threshold (notices, full texts and header blocks of
    licences), 'inherited' for the licence of the nearest
    folder at or above the file's that has a licence file, else null. Of several
    licences the one with the greatest cosine holds, then the first by name.
    Null or empty texts have no licence of their own; rows with equal keys are
    scanned as one; a null folder counts as the empty path.
    """
    spark = files.sparkSession
    files = files.select("file_key", F.coalesce("folder", F.lit("")).alias("folder"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    vocabulary = _vocabulary(templates)
    full = [(f"{name}#{i}", text) for i, (name, text) in enumerate(bodies())]
    counted = materialize(inverse_frequencies(files, sorted({*vocabulary, *_vocabulary(full)})))
    terms, idf = template_terms(spark, templates), counted.where(F.col("word").isin(vocabulary))
    speaking = materialize(files.where(F.lower("text").rlike(SIGNALS)))
    sentences = speaking.select("file_key", F.posexplode(F.filter(F.split("text", r"\n+|(?<=[.!?])\s+"), lambda x: F.lower(x).rlike(SIGNALS))).alias("at", "text"))
    headers = _best_template(sentences, terms, idf, ["file_key", "at"]).where(F.col("cosine") >= HEADER_COSINE)
    whole = _best_template(speaking.select("file_key", "text"), terms, idf, ["file_key"]).where(F.col("cosine") >= FILE_COSINE)
    body = _best_template(speaking.select("file_key", "text"), template_terms(spark, full), counted, ["file_key"]).where(F.col("cosine") >= BODY_COSINE)
    whole = materialize(whole.unionByName(body.withColumn("license", F.substring_index("license", "#", 1))))
    best = F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license")))
    own = headers.select("file_key", "license", "cosine").unionByName(whole).groupBy("file_key").agg(best.alias("b")).select("file_key", F.col("b.license").alias("own"), (-F.col("b.c")).alias("own_score"))
    own = materialize(own)
    governing = speaking.select("file_key", "folder").distinct().join(whole, "file_key").groupBy("folder").agg(best.alias("b")).select(F.col("folder").alias("from_folder"), F.col("b.license").alias("above"), (-F.col("b.c")).alias("above_score"))
    folders = files.select("folder").distinct().select("folder", F.posexplode(ancestors(F.col("folder"))).alias("distance", "from_folder"))
    inherited = folders.join(governing, "from_folder").groupBy("folder").agg(F.min(F.struct("distance", "from_folder", "above", "above_score")).alias("near"))
    out = files.select("file_key", "folder").join(own, "file_key", "left").join(inherited, "folder", "left")
    mine = F.col("own").isNotNull()
    return out.select(
        "file_key",
        "folder",
        F.coalesce("own", "near.above").alias("license"),
        F.coalesce("own_score", "near.above_score").alias("score"),
        F.when(mine, F.lit("own")).when(F.col("near").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(~mine, F.col("near.from_folder")).alias("from_folder"),
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    """Licences of ``documents``: the folder is source/language/block of a thousand ids."""
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("-")))
    out = scan_licenses(docs.select(F.col("doc_id").alias("file_key"), folder.alias("folder"), "text"))
    return out.withColumnRenamed("file_key", "doc_id")




def documents_sql(templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """DuckDB SQL for ``scan_documents``; it knows the notices only, not the full texts and header blocks."""
    values = ", ".join(f"('{name}', '{text}')" for name, text in templates)
    words = "regexp_extract_all(lower({0}), '[a-z0-9]+')"
    return f"""
    WITH tpl(license, t) AS (VALUES {values}),
    terms AS (SELECT license, word, count(*) AS tf FROM (SELECT license, unnest({words.format("t")}) AS word FROM tpl) GROUP BY ALL),
    f AS (SELECT doc_id AS k, concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'), coalesce(cast(floor(doc_id / 1000) AS bigint)::varchar, '-')) AS folder, coalesce(text, '') AS text FROM documents),
    df AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT k, unnest({words.format("text")}) AS word FROM f) WHERE word IN (SELECT word FROM terms) GROUP BY word),
    idf AS (SELECT word, ln((1.0 + (SELECT count(*) FROM f)) / (1.0 + coalesce(n, 0))) + 1 AS idf FROM (SELECT DISTINCT word FROM terms) LEFT JOIN df USING (word)),
    wt AS (SELECT license, word, tf * idf AS wt FROM terms JOIN idf USING (word)),
    tn AS (SELECT license, sqrt(sum(wt * wt)) AS nt FROM wt GROUP BY license),
    sp AS (SELECT * FROM f WHERE regexp_matches(lower(text), '{SIGNALS}')),
    cut AS (SELECT k, string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), '\\n+') AS s FROM sp),
    units AS (SELECT * FROM (SELECT k, unnest(s) AS text, generate_subscripts(s, 1) AS u FROM cut) WHERE regexp_matches(lower(text), '{SIGNALS}') UNION ALL SELECT k, text, 0 FROM sp),
    uw AS (SELECT k, u, word, count(*) * coalesce(any_value(idf), 1.0) AS w FROM (SELECT k, u, unnest({words.format("text")}) AS word FROM units) LEFT JOIN idf USING (word) GROUP BY k, u, word),
    un AS (SELECT k, u, sqrt(sum(w * w)) AS n FROM uw GROUP BY ALL),
    dot AS (SELECT k, u, license, sum(w * wt / nt) AS d FROM uw JOIN wt USING (word) JOIN tn USING (license) GROUP BY ALL),
    co AS (SELECT k, u, license, round(d / n, 6) AS c FROM dot JOIN un USING (k, u)),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, u ORDER BY c DESC, license) AS r FROM co) WHERE r = 1 AND c >= CASE WHEN u = 0 THEN {FILE_COSINE} ELSE {HEADER_COSINE} END),
    own AS (SELECT k, license, c FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, license) AS q FROM best) WHERE q = 1),
    gov AS (SELECT folder AS at_folder, license, c FROM (SELECT folder, license, c, row_number() OVER (PARTITION BY folder ORDER BY c DESC, license) AS q FROM best JOIN f USING (k) WHERE u = 0) WHERE q = 1),
    near AS (SELECT folder, at_folder, license, c FROM (SELECT x.folder, g.*, row_number() OVER (PARTITION BY x.folder ORDER BY length(g.at_folder) DESC) AS q FROM (SELECT DISTINCT folder FROM f) x JOIN gov g ON x.folder = g.at_folder OR starts_with(x.folder, g.at_folder || '/')) WHERE q = 1)
    SELECT f.k AS doc_id, f.folder, coalesce(o.license, n.license) AS license, coalesce(o.c, n.c) AS score,
        CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' END AS origin, CASE WHEN o.license IS NULL THEN n.at_folder END AS from_folder
    FROM f LEFT JOIN own o USING (k) LEFT JOIN near n ON n.folder = f.folder"""
