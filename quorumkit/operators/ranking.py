"""Row numbers and running sums inside groups of any size, without sorting a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumkit.sinks.shared import materialize


def running_sum(df: DataFrame, keys: list[str], order: list[str | Column], value: Column | None = None, name: str = "n_before") -> DataFrame:
    """Add the sum of ``value`` (1 if not given) over the rows of the same keys that stand before a row.

    Rows are range-partitioned by keys and order with sampled splitters, so a
    group with a third of all rows is spread over many tasks, and written once,
    so that the partitions stay as they are. Sums run inside each partition;
    what comes before a partition is added up from one row for each partition
    and group. Ties of ``order`` are numbered in any order; null keys are a
    group of their own; no rows give no rows.
    """
    ranged = df.withColumn("__value", F.lit(1).cast("long") if value is None else value.cast("long")).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    at = F.monotonically_increasing_id()
    ranged = materialize(ranged.withColumns({"__part": F.shiftright(at, 33), "__pos": at}))
    sums = ranged.groupBy(*keys, "__part").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__part").alias("__p"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    here = ranged.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.col("__part") == F.col("__p"))
    return here.join(starts, same).select(*df.columns, (F.col("__start") + F.col("__inside")).alias(name))
