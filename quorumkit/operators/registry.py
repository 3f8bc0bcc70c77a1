"""Plug-in annotators: named functions from reads to a (seq, taxid) report."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeResult

from quorumkit.sources.reports import constant_report

Annotator = Callable[[DataFrame], DataFrame]
_ANNOTATORS: dict[str, Annotator] = {}


def register(name: str, annotator: Annotator) -> None:
    """Make an annotator known; a later one of the same name replaces it."""
    _ANNOTATORS[name.lower()] = annotator


def annotator(name: str) -> Annotator:
    """The annotator of a tool; unknown names are custom tools that pass a (seq, taxid) table through."""
    return _ANNOTATORS.get(name.lower(), lambda report: report.select("seq", "taxid"))


def from_model(predict: Callable[[pd.DataFrame], pd.Series]) -> Annotator:
    """An annotator from a function of a batch of reads (read_id, seq) to labels."""

    def run(reads: DataFrame) -> DataFrame:
        def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                yield pd.DataFrame({"seq": f["read_id"], "taxid": predict(f).astype(str)})

        return reads.select("read_id", "seq").mapInPandas(batches, "seq string, taxid string")

    return run


def register_emitter(spark: SparkSession, name: str, emitter: type, columns: str) -> None:
    """Make a user's multi-row emitter a table function of SQL, with PARTITION BY and ORDER BY.

    ``emitter()`` is made anew for each partition of the table argument; its
    ``rows(row)`` gives any number of tuples for a row (a dict), its ``finish()``,
    if there is one, more after the last. ``columns`` (DDL) names their fields.
    The function is polymorphic: names of input columns given as the second
    argument (comma-separated) come first in the output, with the input's types;
    what ``finish`` gives stands with those of the last row.
    """
    made = StructType.fromDDL(columns)

    class Emit:
        @staticmethod
        def analyze(table, keep=None) -> AnalyzeResult:
            names = [c.strip() for c in (keep.value if keep is not None else "").split(",") if c.strip()]
            kept = [table.dataType[c] for c in names]
            return AnalyzeResult(StructType([*kept, *made]))

        def __init__(self):
            self.own, self.kept = emitter(), None

        def eval(self, table, keep=None):
            row = table.asDict()
            self.kept = tuple(row[c.strip()] for c in (keep or "").split(",") if c.strip())
            for out in self.own.rows(row):
                yield self.kept + tuple(out)

        def terminate(self):
            if self.kept is not None and hasattr(self.own, "finish"):
                for out in self.own.finish():
                    yield self.kept + tuple(out)

    spark.udtf.register(name, F.udtf(Emit))


def annotate(reads: DataFrame, tools: list[str], sample: str = "sample") -> DataFrame:
    """Long reports of several annotators over the same reads."""
    out = None
    for i, tool in enumerate(tools):
        got = annotator(tool)(reads).select(F.lit(sample).alias("sample"), F.lit(tool).alias("tool"), F.lit(0).alias("run_idx"), "seq", "taxid", F.lit(None).cast("string").alias("length"), F.lit(i).cast("long").alias("line_no"))
        out = got if out is None else out.unionByName(got)
    return out


register("constant", constant_report)
register("constant9606", constant_report)
register("dummy9606", constant_report)
