"""Semi-joins by row number that move nothing of the large table.

Row numbers are those of ``monotonically_increasing_id``: the high bits name the
task that wrote a row, so rows of one task have numbers of one stretch and stay
together in the files. The numbers to look for are written with a folder for
each stretch, and a task that reads rows opens the folders of the stretches it
meets. Only the numbers are shuffled, never the rows.
"""

from __future__ import annotations

from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumkit.sinks.shared import new_path

from .common import shuffle_partitions

#: Low bits of a row number that count the rows of one task.
STRETCH_BITS = 33


def _numbers(path: str, stretch: int) -> np.ndarray:
    """Sorted numbers of one stretch; none if nothing of it is wanted."""
    system, root = arrow_fs.FileSystem.from_uri(path) if urlsplit(path).scheme else (arrow_fs.LocalFileSystem(), path)
    found = system.get_file_info(arrow_fs.FileSelector(f"{root}/stretch={stretch}", allow_not_found=True))
    parts = [pq.ParquetFile(system.open_input_file(f.path)).read(["number"]).column(0).to_numpy() for f in found if f.path.endswith(".parquet")]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def rows_in(rows: DataFrame, wanted: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Rows of which column ``key``, a row number, is one of the single column of ``wanted``.

    Repeated numbers in ``wanted`` count once and its nulls not at all; a null
    key is never in it. The result is the same for any longs, but the memory of
    a task is bounded (by the numbers of one writing task) and its reads are few
    only for rows that lie as they were written. The numbers are written to
    ``path`` or a new path, and the result reads them there.
    """
    spark, path = rows.sparkSession, path or new_path(rows.sparkSession)
    number = F.col(wanted.columns[0]).cast("long")
    listed = wanted.select(number.alias("number"), F.shiftright(number, STRETCH_BITS).alias("stretch")).where("number is not null")
    dealt = listed.repartition(shuffle_partitions(spark), "stretch").sortWithinPartitions("stretch")
    dealt.write.partitionBy("stretch").parquet(path)

    @F.arrow_udf("boolean")
    def among(keys: pa.Array) -> pa.Array:
        known = ~np.asarray(keys.is_null())
        values = keys.fill_null(0).to_numpy(zero_copy_only=False)
        out, stretch = np.zeros(len(values), bool), values >> STRETCH_BITS
        for s in np.unique(stretch[known]).tolist():
            if held.get("stretch") != s:
                held.update(stretch=s, numbers=_numbers(path, s))
            mine, numbers = known & (stretch == s), held["numbers"]
            if len(numbers):
                at = np.minimum(np.searchsorted(numbers, values[mine]), len(numbers) - 1)
                out[mine] = numbers[at] == values[mine]
        return pa.array(out)

    held: dict[str, object] = {}  # the stretch at hand; a task's copy is its own
    return rows.where(among(F.col(key)))
