"""FASTQ and FASTA files as Spark data sources, read in byte ranges.

A plain file is cut into ranges that are read on their own; a record belongs to
the range in which its first byte lies, and its reader goes on beyond the end of
the range as far as the record does. A gzip file is one range. Files are reached
through Arrow's file systems (local paths and file:, hdfs:, s3: and gs: addresses).
"""

from __future__ import annotations

import fnmatch
import json
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of a piece that is read at once, and of a batch of records; records of a batch.
RANGE_BYTES, READ_BYTES, BATCH_BYTES, BATCH_ROWS = 64 << 20, 1 << 20, 8 << 20, 20_000
#: Tasks of a scan at most; more ranges than that are read several to a task.
MOST_TASKS = 4096


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    return arrow_fs.FileSystem.from_uri(path) if ":/" in path else (arrow_fs.LocalFileSystem(), path)


def find_files(paths: list[str]) -> list[tuple[str, int]]:
    """(address, bytes) of files, of the files below folders and of those that match a pattern; hidden ones are skipped."""
    found = []
    for path in paths:
        fs, inner = file_system(path)
        prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        folder, _, last = inner.rpartition("/")
        if any(c in last for c in "*?["):
            infos = [i for i in fs.get_file_info(arrow_fs.FileSelector(folder)) if fnmatch.fnmatch(i.base_name, last)]
        else:
            info = fs.get_file_info(inner)
            if info.type == arrow_fs.FileType.NotFound:
                raise FileNotFoundError(path)
            infos = fs.get_file_info(arrow_fs.FileSelector(inner, recursive=True)) if info.type == arrow_fs.FileType.Directory else [info]
        found += [(prefix + i.path, i.size) for i in infos if i.type == arrow_fs.FileType.File and not i.base_name.startswith(("_", "."))]
    return sorted(found)


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class ByteRanges(InputPartition):
    """Ranges that one task reads one after the other."""

    ranges: list[ByteRange]


def lines_from(path: str, start: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin at ``start`` or later, without their line ends."""
    fs, inner = file_system(path)
    if path.endswith(".gz"):
        stream = fs.open_input_stream(inner, compression="gzip")
    else:
        stream = fs.open_input_file(inner)
        stream.seek(max(0, start - 1))  # the byte before tells whether a line begins at ``start``
    with stream:
        at, rest, skip = max(0, start - 1), b"", start > 0
        while True:
            piece = stream.read(READ_BYTES)
            lines = (rest + piece).split(b"\n")
            rest = lines.pop() if piece else b""
            if not piece and lines == [b""]:
                return
            for line in lines:
                if not skip:
                    yield at, line.removesuffix(b"\r")
                skip, at = False, at + len(line) + 1
            if not piece:
                return


class RecordReader(DataSourceReader):
    """Records of all ranges as batches of (file, block, at, fields...): ``block`` is the range's start, ``at`` the record's number in it."""

    fields: tuple[str, ...] = ()

    def __init__(self, options):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path, size in find_files(self.paths):
            step = size if path.endswith(".gz") else self.range_bytes
            out += [ByteRange(path, a, 1 << 62 if path.endswith(".gz") else a + step) for a in range(0, max(size, 1), max(step, 1))]
        each = -(-len(out) // MOST_TASKS)
        return out if each <= 1 else [ByteRanges(out[i : i + each]) for i in range(0, len(out), each)]

    def records(self, part: ByteRange) -> Iterator[tuple[str, ...]]:
        raise NotImplementedError

    def read(self, partition: ByteRange | ByteRanges) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges if isinstance(partition, ByteRanges) else [partition]:
            yield from self._read_range(part)

    def _read_range(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        rows, size, done = [], 0, 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array([partition.path] * len(rows)), pa.array([partition.start] * len(rows), pa.int64()), pa.array(range(done - len(rows), done), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.string()) for c in zip(*rows))], names=["file", "block", "at", *self.fields])

        for record in self.records(partition):
            rows.append(tuple(f.decode("utf-8", "replace") for f in record))
            size += sum(map(len, record))
            done += 1
            if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


class FastqReader(RecordReader):
    """Records of four lines.

    A range's first record is found by its shape: a line that begins with '@'
    two lines before one that begins with '+'. A quality line may begin with
    '@' too, but two lines after it stand bases, never a '+'.
    """

    fields = ("header", "seq", "qual")

    def records(self, part: ByteRange):
        lines, held = lines_from(part.path, part.start), deque()
        if part.start:
            for line in lines:
                held.append(line)
                while len(held) > 2 and not (held[0][1].startswith(b"@") and held[2][1].startswith(b"+")):
                    held.popleft()
                if len(held) > 2:
                    break
        while True:
            while len(held) < 4:
                line = next(lines, None)
                if line is None:
                    return  # a truncated record ends it
                held.append(line)
            (offset, header), (_, seq), _, (_, qual) = (held.popleft() for _ in range(4))
            if offset >= part.end:
                return
            yield header.removeprefix(b"@"), seq, qual


class FastaReader(RecordReader):
    """Records that begin with a '>' line; blank lines go, wrapped sequences are joined."""

    fields = ("header", "sequence")

    def records(self, part: ByteRange):
        header, pieces = None, []
        for offset, line in lines_from(part.path, part.start):
            if line.startswith(b">"):
                if header is not None:
                    yield header, b"".join(pieces)
                if offset >= part.end:
                    return
                header, pieces = line[1:].strip(), []
            elif header is not None:
                pieces += line.split()
            elif offset >= part.end:
                return
        if header is not None:
            yield header, b"".join(pieces)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quorum_fastq"

    def schema(self) -> str:
        return "file string, block long, at long, header string, seq string, qual string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quorum_fasta"

    def schema(self) -> str:
        return "file string, block long, at long, header string, sequence string"

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options)


def load(spark: SparkSession, source: type[DataSource], paths: str | list[str], range_bytes: int | None = None):
    """The records of files or folders; ``range_bytes`` sets the size of a range."""
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("paths", json.dumps([paths] if isinstance(paths, str) else list(paths)))
    return (reader.option("rangebytes", str(range_bytes)) if range_bytes else reader).load()
