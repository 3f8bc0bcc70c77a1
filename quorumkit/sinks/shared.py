"""The folder that driver and executors share, for results that are read more than once."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of the innermost open ``scratch`` block; each thread has its own.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)

#: For writes whose plans run once: a write's shuffle files are deleted as it ends, not when the driver happens to collect its plan, and rows are not sorted by the folder they go to while a task has no more folders than this.
LEAN_WRITES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "64"}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of our own only where none is set and all runs on one machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="quorumkit-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps what it writes on the way."""
    return f"{shared_dir(spark)}/quorumkit-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    return f"{_scratch.get() or run_folder(spark)}/{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, where: str) -> None:
    """Delete a file or folder of any file system that Spark reaches; none is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What the block writes to new paths is deleted at its end.

    Nothing that is read after the block may be written there: such a table
    needs a path that was drawn before the block.
    """
    folder = new_path(spark)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete_path(spark, folder)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session, with a default in Spark, that hold for what the block runs."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def remove_run_folder(spark: SparkSession) -> None:
    """Delete what this application wrote on the way, once its results are stored elsewhere."""
    delete_path(spark, run_folder(spark))


def materialize(df: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once, to a new path if none is given, and return it read back; its lineage ends in files that survive the loss of any executor.

    Used wherever a result is read more than once or a sampled partitioning
    must not be drawn anew.
    """
    path = path or new_path(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
