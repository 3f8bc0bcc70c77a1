"""CSV files with names of their own, written by tasks and put in place by one commit.

Tasks write below a temporary folder of the job; the commit only renames what
finished tasks reported, so a task that fails or runs twice leaves nothing. A
file of any size is written in pieces by many tasks, which then copy their
pieces to their places in it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quorumkit.operators.ranking import running_sum
from quorumkit.sinks.shared import materialize
from quorumkit.sources.records import file_system

#: Bytes that a task copies at once, and files that a commit renames at the same time.
COPY_BYTES, RENAMES = 8 << 20, 16


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (path now, name to have)."""

    files: list[tuple[str, str]]


def csv_rows(columns: list[pa.Array]) -> list[str]:
    """Each row as a line without its end; a value is quoted only where it must be, a null is empty (in a table of one column, quotes)."""
    texts = []
    for column in columns:
        text = column.cast(pa.string())
        quoted = pc.binary_join_element_wise('"', pc.replace_substring(text, '"', '""'), '"', "")
        texts.append(pc.fill_null(pc.if_else(pc.match_substring_regex(text, '[,"\r\n]'), quoted, text), ""))
    if len(texts) == 1:
        texts = [pc.if_else(pc.equal(texts[0], ""), '""', texts[0])]
    return pc.binary_join_element_wise(*texts, ",").to_pylist()


def csv_lines(columns: list[pa.Array]) -> bytes:
    return ("\n".join(csv_rows(columns)) + "\n").encode()


class NamedCsvWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.job = f"_temporary-{uuid.uuid4().hex}"
        fs, folder = self._places()
        fs.create_dir(f"{folder}/{self.job}", recursive=True)  # once, so that a late task of a failed job does not bring it back

    def _places(self) -> tuple[arrow_fs.FileSystem, str]:
        fs, inner = file_system(self.path)
        return fs, inner.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows come in runs of one file name, which is the first column."""
        fs, folder = self._places()
        own = f"{folder}/{self.job}/{uuid.uuid4().hex}"
        files, stream, name = [], None, None

        for batch in iterator:
            names = batch.column(0).to_pylist()
            rest = batch.select(range(1, batch.num_columns))
            at = 0
            while at < len(names):
                end = at + 1
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if names[at] != name:
                    if stream is not None:
                        stream.close()
                    name = names[at]
                    files.append((f"{own}-{len(files)}", name))
                    stream = fs.open_output_stream(files[-1][0])
                    stream.write(csv_lines([pa.array([c]) for c in rest.schema.names]))
                stream.write(csv_lines(rest.slice(at, end - at).columns))
                at = end
        if stream is not None:
            stream.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = self._places()
        fs.create_dir(folder, recursive=True)
        if self.overwrite:
            for old in fs.get_file_info(arrow_fs.FileSelector(folder)):
                if old.type == arrow_fs.FileType.File:
                    fs.delete_file(old.path)
        for now, name in (f for m in messages if m is not None for f in m.files):
            fs.move(now, f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = self._places()
        if fs.get_file_info(f"{folder}/{self.job}").type == arrow_fs.FileType.Directory:
            fs.delete_dir(f"{folder}/{self.job}")


class NamedCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quorum_named_csv"

    def writer(self, schema, overwrite: bool) -> NamedCsvWriter:
        return NamedCsvWriter(self.options, overwrite)


def _pieces(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the runs of each file name (first column; the second is the task's number) to files below ``folder``; each has the header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = file_system(folder)
        own, found, stream, head = f"{inner}/{uuid.uuid4().hex}", [], None, b""
        for batch in batches:
            names, part = batch.column(0).to_pylist(), batch.column(1)[0].as_py() if batch.num_rows else 0
            rest = batch.select(range(2, batch.num_columns))
            rows, at = csv_rows(rest.columns), 0
            while at < len(names):
                end = at + 1
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if not found or names[at] != found[-1][0]:
                    if stream is not None:
                        stream.close()
                    head = head or csv_lines([pa.array([c]) for c in rest.schema.names])
                    found.append([names[at], part, f"{own}-{len(found)}", len(head), len(head)])
                    stream = fs.open_output_stream(found[-1][2])
                    stream.write(head)
                lines = ("\n".join(rows[at:end]) + "\n").encode()
                stream.write(lines)
                found[-1][4] += len(lines)
                at = end
        if stream is not None:
            stream.close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*found)], names=["name", "part", "piece", "head", "size"])

    return run


def _copy(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Copy pieces (target, sources, starts, offset) one after the other: into a file that stands, or, without an offset, as a new file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        done = 0
        for row in (r for b in batches for r in b.to_pylist()):
            out = fs.open_output_stream(row["target"]) if row["offset"] is None else None
            file, at = (None, 0) if out else (os.open(row["target"], os.O_WRONLY), row["offset"])
            for source, start in zip(row["sources"], row["starts"]):
                with fs.open_input_file(source) as piece:
                    piece.seek(start)
                    while data := piece.read(COPY_BYTES):
                        if out:
                            out.write(data)
                        else:
                            view = memoryview(data)
                            while view:
                                n = os.pwrite(file, view, at)
                                at, view = at + n, view[n:]
            out.close() if out else os.close(file)
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["done"])

    return run


def _write_whole(rows: DataFrame, file: Column, order: list[str], keep: list[str], path: str) -> None:
    """One file for each name, whatever its size.

    Rows are range-partitioned by name and order, so a large file is in pieces
    of many tasks. Tasks then copy the pieces to their places in the file; on
    file systems that cannot write at a place one task copies all of a file, as a stream.
    """
    spark = rows.sparkSession
    fs, folder = file_system(path)
    folder = folder.rstrip("/")
    prefix = path.rstrip("/")[: len(path.rstrip("/")) - len(folder)]
    job = f"{folder}/_temporary-{uuid.uuid4().hex}"
    fs.create_dir(job, recursive=True)
    try:
        named = rows.withColumn("__file", file)
        # a number of our own: rows may be few and files many, which tasks merged by their bytes would write one after the other
        ranged = named.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "__file", *order).sortWithinPartitions("__file", *order)
        dealt = ranged.select("__file", F.spark_partition_id().alias("__part"), *(F.col(f"`{c}`") for c in keep))
        listed = materialize(dealt.mapInArrow(_pieces(prefix + job), "name string, part long, piece string, head long, size long"))
        files: dict[str, list] = {}
        for r in listed.orderBy("name", "part").collect():  # a row for each file, and one for each task
            files.setdefault(r["name"], []).append(r)
        whole, copies = {}, []
        for i, (name, pieces) in enumerate(files.items()):
            whole[name] = pieces[0]["piece"]
            if len(pieces) > 1:
                whole[name] = target = f"{job}/whole-{i}"
                starts = [0] + [p["head"] for p in pieces[1:]]
                if isinstance(fs, arrow_fs.LocalFileSystem):
                    fs.open_output_stream(target).close()
                    at = 0
                    for p, start in zip(pieces, starts):
                        copies.append((target, [p["piece"]], [start], at))
                        at += p["size"] - start
                else:
                    copies.append((target, [p["piece"] for p in pieces], starts, None))
        if copies:
            asked = spark.createDataFrame(copies, "target string, sources array<string>, starts array<long>, offset long")
            asked.repartition(min(len(copies), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(_copy(prefix + job), "done long").agg(F.sum("done")).collect()
        with ThreadPoolExecutor(RENAMES) as pool:
            old = [f.path for f in fs.get_file_info(arrow_fs.FileSelector(folder)) if f.type == arrow_fs.FileType.File]
            list(pool.map(fs.delete_file, old))
            list(pool.map(lambda f: fs.move(f[1], f"{folder}/{f[0]}"), whole.items()))
    finally:
        fs.delete_dir(job)


def write_named(rows: DataFrame, name: Column, ending: str, order: list[str], path: str, drop: Sequence[str] = (), file_rows: int | None = None) -> None:
    """Write the rows of each ``name`` to <name><ending> in a folder, in the given order, with a header; files that were there go.
    Columns in ``drop`` are left out.

    A name has one file, however large. With ``file_rows`` a name with more rows
    than that goes on in <name>.2<ending>, <name>.3<ending> and so on.
    Characters that do not fit a file name become '_'; names that then are the
    same share their files; a null name is 'null'. Rows that ``order`` leaves
    equal go by their other columns, in the order of the columns' names.
    """
    safe = F.regexp_replace(F.coalesce(name, F.lit("null")), "[^A-Za-z0-9._-]+", "_")
    keep = [c for c in rows.columns if c not in drop]
    order = [*order, *(f"`{c}`" for c in sorted(keep) if c not in order)]
    if file_rows is None:
        return _write_whole(rows, F.concat(safe, F.lit(ending)), order, keep, path)
    placed = running_sum(rows.withColumn("__name", safe), ["__name"], order, name="__at")
    turn = F.floor(F.col("__at") / file_rows) + 1
    file = F.concat("__name", F.when(turn > 1, F.concat(F.lit("."), turn.cast("string"))).otherwise(""), F.lit(ending))
    dealt = placed.select(file.alias("__file"), "__at", *(F.col(f"`{c}`") for c in keep)).repartition("__file").sortWithinPartitions("__file", "__at").drop("__at")
    rows.sparkSession.dataSource.register(NamedCsv)
    dealt.write.format(NamedCsv.name()).mode("overwrite").save(path)
