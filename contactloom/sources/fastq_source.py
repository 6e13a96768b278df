"""FASTQ as a data source: `spark.read.format("fastq").load(path)`, or `scan_fastq`.

A file is dealt to splits by bytes, and a split's task reads the records whose headers begin in it: it seeks to the split's
begin and looks for the first line that begins with @ and is followed by a + two lines later. That is a header and nothing
else: two lines after a quality line comes a sequence, which no + begins; sequences and separators don't begin with @. So
records come whole, without a shuffle and without numbering lines. Compressed files can't be entered in the middle and are
one split each.

Paths are read through Arrow's file systems (local, HDFS, S3, GCS by their URIs) by the executors.

Edge cases: lines before the first header and a record cut off at the end of a file are skipped; CR LF ends lines too; an
empty file has no rows; records of a file that is not FASTQ are not found. A split smaller than a record has none.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, offset long, header string, seq string, plus string, qual string"
SPLIT = 128 << 20
#: Records in an Arrow batch, and bytes read at once.
BATCH, BUFFER = 8192, 1 << 20


@dataclass
class Split(InputPartition):
    path: str
    begin: int
    end: int | None


def _open_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


class FastqReader(DataSourceReader):
    def __init__(self, paths: list[str], split: int):
        self.paths, self.split = paths, split

    def partitions(self) -> list[Split]:
        """Splits of all files; folders are listed, hidden files left out."""
        out: list[Split] = []
        for path in self.paths:
            system, at = _open_system(path)
            head = path[: len(path) - len(at)] if "://" in path and path.endswith(at) else ""
            info = system.get_file_info(at)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
            for f in sorted((f for f in files if f.type == fs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path):
                if f.path.endswith((".gz", ".bz2", ".zst")):
                    out.append(Split(head + f.path, 0, None))
                else:
                    out += [Split(head + f.path, a, min(a + self.split, f.size)) for a in range(0, f.size, self.split)]
        return out or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, at = _open_system(partition.path)
        names = ["path", "offset", "header", "seq", "plus", "qual"]
        with system.open_input_stream(at) if partition.end is None else system.open_input_file(at) as f:
            rows: list[tuple] = []
            for record in records(f, partition.begin, partition.end):
                rows.append(record)
                if len(rows) == BATCH:
                    yield _batch(partition.path, rows, names)
                    rows = []
            if rows:
                yield _batch(partition.path, rows, names)


def _batch(path: str, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    offset, *texts = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(offset, pa.int64()), *(pa.array([t.decode() for t in column], pa.string()) for column in texts)], names)


def _lines(f: pa.NativeFile, begin: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) from the first line that begins at or after `begin`."""
    rest, at = b"", max(begin - 1, 0)
    if begin:
        f.seek(at)
    skip = begin > 0  # the end of the line before
    while data := f.read(BUFFER):
        rest += data
        lines = rest.split(b"\n")
        rest = lines.pop()
        for line in lines:
            if not skip:
                yield at, line.removesuffix(b"\r")
            skip = False
            at += len(line) + 1
    if rest and not skip:
        yield at, rest.removesuffix(b"\r")


def records(f: pa.NativeFile, begin: int, end: int | None) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """(offset, header, seq, plus, qual) of the records whose headers begin from `begin` on and before `end`."""
    lines = _lines(f, begin)
    held: list[tuple[int, bytes]] = []
    for line in lines:
        held.append(line)
        if len(held) < 4:
            continue
        if held[0][1].startswith(b"@") and held[2][1].startswith(b"+"):
            if end is not None and held[0][0] >= end:
                return
            yield held[0][0], *(text for _, text in held)
            held = []
        else:
            held.pop(0)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader([p for p in self.options.get("path", "").split(",") if p], int(self.options.get("split", SPLIT)))


def scan_fastq(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, offset, header, seq, plus, qual) of all records of a file or folder; offset is the header's first byte and so
    orders a file's records."""
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("split", split).load(path)
