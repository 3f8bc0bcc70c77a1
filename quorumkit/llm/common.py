"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumkit.sinks import shared
from quorumkit.sinks.shared import scratch, shared_dir  # noqa: F401  (used by the operators)

#: Bytes of an Arrow batch on its way to a Python worker; a little less than ``ragged.SLICE_BYTES``, so a batch of texts is one slice.
BATCH_BYTES = 15 << 18
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Codec of tables that carry whole texts until a result is stored.
TEXT_CODEC = "zstd"
#: Seconds between two requests to drop shuffle files.
RELEASE_SECONDS = 3
_released = [0.0]


def materialize(df: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return it read back; the shuffle files of earlier writes are given back.

    Spark deletes the files of a shuffle when the driver collects the plan that
    owned it, which a driver with memory to spare may put off beyond the end of
    a pipeline. Written tables need no shuffle, so the collection is asked for here.
    """
    out = shared.materialize(df, path, compression)
    if time.monotonic() - _released[0] >= RELEASE_SECONDS:
        df.sparkSession.sparkContext._jvm.System.gc()
        _released[0] = time.monotonic()
    return out


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches to ``BATCH_BYTES`` unless the session has a limit of its own.

    Spark's default is 10,000 rows or 64 MB. Such a batch of texts stands in the
    JVM, in the worker that reads it and, until the next one comes, in idle workers.
    """
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


_WORKER: dict[Hashable, object] = {}


def worker_object(key: Hashable, make: Callable[[], object]):
    """An object that a Python worker keeps from task to task.

    A worker keeps one at a time: asking for another key drops the former, so
    the stages of a pipeline do not add up their caches.
    """
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def release_memory() -> None:
    """Give freed memory back to the system after a batch; a Python worker lives on for the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
