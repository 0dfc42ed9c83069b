"""Files by byte ranges: a Python data source that plans files and ranges, reads leading bytes only, and streams digests.

No file is held whole, so that files of any size are read, and tasks get about equal bytes. The planner lists files once;
executors open them through pyarrow's file systems (local, hdfs, s3, gs), 1 MiB at a time."""

from __future__ import annotations

import csv
import hashlib
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEAD = 1024
#: Bytes that one task reads of several files, about, and of one file at once.
TASK_BYTES = 1 << 27
_PIECE = 1 << 20
SCHEMA = "path string, length long, start long, head binary, sha256 string, newlines long"


@dataclass
class Piece(InputPartition):
    """(path, length, first byte, byte after the last) of what one task reads."""

    ranges: list

    def __init__(self, ranges: list):
        self.ranges = ranges


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def listed(path: str) -> list[tuple[str, int]]:
    """(path, length) of a file, of all files below a folder, or of those that a glob names or that lie below folders that
    it names; not of those whose names, or folders, begin with _ or ."""
    fs, at = file_system(path)
    parts = at.rstrip("/").split("/")
    fixed = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), len(parts))
    base, pattern = "/".join(parts[:fixed]) or "/", parts[fixed:]
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    out = []
    for f in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
        below = f.path[len(base) :].strip("/").split("/")
        if f.type == pafs.FileType.File and not any(x[0] in "_." for x in below) and len(below) >= len(pattern) and all(map(fnmatchcase, below, pattern)):
            out.append((path.rstrip("/").rsplit("/", len(pattern))[0] + f.path[len(base.rstrip("/")) :], f.size) if pattern else (path.rstrip("/") + f.path[len(base.rstrip("/")) :], f.size))
    return sorted(out)


def planned(files: list[tuple[str, int]], mode: str, head: int, range_bytes: int, task_bytes: int) -> list[Piece]:
    """Ranges of all files, dealt to tasks of some task_bytes: leading bytes (head), whole files (digest: a digest runs
    through its file from the start), or ranges of range_bytes (ranges)."""
    ranges = []
    for path, length in files:
        if mode == "ranges":
            ranges += [(path, length, at, min(at + range_bytes, length)) for at in range(0, max(length, 1), range_bytes)]
        else:
            ranges.append((path, length, 0, min(head, length) if mode == "head" else length))
    out, now, size = [], [], 0
    for one in ranges:
        cost = one[3] - one[2] + _PIECE // 16  # opening a file costs something as well
        if now and size + cost > task_bytes:
            out.append(Piece(now))
            now, size = [], 0
        now.append(one)
        size += cost
    return [*out, Piece(now)] if now else out


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.mode = options.get("mode", "head")
        self.head, self.range_bytes, self.task_bytes = (int(options.get(k, d)) for k, d in (("head", HEAD), ("rangebytes", TASK_BYTES), ("taskbytes", TASK_BYTES)))
        self.paths = options["paths"].split("\n")

    def partitions(self) -> list[Piece]:
        files = sorted({f for p in self.paths for f in listed(p)})
        return planned(files, self.mode, self.head, self.range_bytes, self.task_bytes) or [Piece([])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        for path, length, start, stop in partition.ranges:
            fs, at = file_system(path)
            digest, head, newlines, place = hashlib.sha256(), b"", 0, start
            with fs.open_input_file(at) as f:
                f.seek(start)
                while place < stop:
                    piece = f.read(min(_PIECE, stop - place))
                    if not piece:
                        raise OSError(f"{path} ends at byte {place}, not {length}")
                    if len(head) < self.head:
                        head += piece[: self.head - len(head)]
                    if self.mode != "head":
                        digest.update(piece)
                        newlines += piece.count(b"\n")
                    place += len(piece)
            whole = self.mode == "digest"
            cols = [[path], [length], [start], [head], [digest.hexdigest() if whole else None], [newlines if self.mode != "head" else None]]
            types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in SCHEMA.split(", ")])


class FileRanges(DataSource):
    """Options: paths (one a line), mode (head, digest, ranges), head, rangeBytes, taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "quern_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def file_ranges(spark: SparkSession, paths: str | list[str], mode: str = "head", **options) -> DataFrame:
    """(path, length, start, head, sha256, newlines) of files and of all files below folders: one row per file with its
    leading bytes (head), also with its digest and line feeds (digest), or one per range of it (ranges)."""
    spark.dataSource.register(FileRanges)
    reader = spark.read.format("quern_ranges").option("mode", mode).option("paths", "\n".join([paths] if isinstance(paths, str) else paths))
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()


def header_names(head: bytes, encoding: str, whole: bool) -> list[str]:
    """Column names in the first record of a CSV file, from its leading bytes: quoted names may hold separators and line
    ends. A header that is longer than these bytes (whole: the file has no more) is an error."""
    text = head.decode(encoding, errors="ignore").removeprefix("﻿")
    quoted, end = False, None
    for i, c in enumerate(text):
        quoted ^= c == '"'
        if c in "\r\n" and not quoted:
            end = i
            break
    if end is None and not whole:
        raise ValueError(f"a header is longer than {len(head)} bytes")
    return [c.strip() for c in next(csv.reader(io.StringIO(text[:end], newline="")), [])]


def headers(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8", head: int = 1 << 16) -> DataFrame:
    """(path, columns) of every CSV file, in one pass over leading bytes; an empty file has no columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [header_names(h, encoding, n <= len(h)) for h, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.list_(pa.string()))], ["path", "columns"])

    return file_ranges(spark, paths, head=head).select("path", "head", "length").mapInArrow(run, "path string, columns array<string>")


def read_layouts(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8", head: int = 1 << 16) -> DataFrame:
    """All CSV files as one table of text, columns that a file lacks NULL, with _source_file: one job reads the headers,
    files of one header are one scan. Files without a header give no rows; a repeated column is an error."""
    layouts: dict[tuple, list[str]] = {}
    for row in headers(spark, paths, encoding, head).collect():  # names of files, which a scan takes from the driver
        layouts.setdefault(tuple(row.columns), []).append(row.path)
    out = None
    for columns, files in sorted(layouts.items()):
        if not columns:
            continue
        if clash := sorted({c for c in columns if columns.count(c) > 1}):
            raise ValueError(f"header columns collide in {files[0]}: {clash}")
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
        one = spark.read.schema(schema).option("header", True).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(sorted(files))
        one = one.withColumn("_source_file", F.col("_metadata.file_path"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no file has a header")
    return out
