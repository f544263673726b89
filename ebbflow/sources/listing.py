"""A Spark data source that lists files (S1), hidden and empty ones included.

Spark's own file sources leave out names that start with ``_`` or ``.`` and
give no row for a file without bytes. ``ebbflow_files`` lists a tree with one
task for each first-level folder: a task walks its folders one at a time, so it
holds one folder's entries. Local paths are walked as they are, others through
Arrow's file systems. A root that cannot be listed raises.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ebbflow.session import ship_package
from ebbflow.sources.blocks import arrow_place, is_local

_ROWS = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modification_time", pa.timestamp("us", tz="UTC"))])
_BATCH = 10_000


class Entry:
    __slots__ = ("path", "length", "time", "is_folder")

    def __init__(self, path: str, length: int, time: float, is_folder: bool):
        self.path, self.length, self.time, self.is_folder = path, length, time, is_folder


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def look(path: str) -> Entry:
    """The entry of one path; raises if there is none."""
    if is_local(path):
        s = os.stat(_local(path))
        return Entry("file:" + _local(path), s.st_size, s.st_mtime, os.path.isdir(_local(path)))
    fs, inside, _, _ = arrow_place(path)
    info = fs.get_file_info(inside)
    if info.type.name == "NotFound":
        raise FileNotFoundError(path)
    return Entry(path, info.size or 0, info.mtime.timestamp() if info.mtime else 0.0, info.type.name == "Directory")


def entries(folder: str) -> Iterator[Entry]:
    """What a folder holds directly."""
    if is_local(folder):
        with os.scandir(_local(folder)) as found:
            for e in found:
                s = e.stat()
                yield Entry("file:" + e.path, s.st_size, s.st_mtime, e.is_dir())
        return
    from pyarrow.fs import FileSelector

    fs, inside, prefix, base = arrow_place(folder)
    for info in fs.get_file_info(FileSelector(inside)):
        yield Entry(prefix + info.path[len(base):], info.size or 0, info.mtime.timestamp() if info.mtime else 0.0, info.type.name == "Directory")


def walk(folder: str) -> Iterator[Entry]:
    """Every file below a folder."""
    todo = [folder]
    while todo:
        for e in entries(todo.pop()):
            if e.is_folder:
                todo.append(e.path)
            else:
                yield e


class _Part(InputPartition):
    """A folder to walk, or single files."""

    def __init__(self, folder: str | None, files: list[tuple[str, int, float]]):
        self.folder, self.files = folder, files


class FileListing(DataSource):
    """Options: ``roots``, a JSON list of files and folders."""

    @classmethod
    def name(cls) -> str:
        return "ebbflow_files"

    def schema(self) -> str:
        return "path string, length bigint, modification_time timestamp"

    def reader(self, schema) -> DataSourceReader:
        return FileListingReader(json.loads(self.options["roots"]))


class FileListingReader(DataSourceReader):
    def __init__(self, roots: list[str]):
        self.roots = roots

    def partitions(self) -> list[InputPartition]:
        parts, single = [], []
        for root in self.roots:
            at = look(root)
            for e in entries(root) if at.is_folder else [at]:
                if e.is_folder:
                    parts.append(_Part(e.path, []))
                else:
                    single.append((e.path, e.length, e.time))
        parts += [_Part(None, single[i:i + _BATCH]) for i in range(0, len(single), _BATCH)]
        return parts or [_Part(None, [])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int, float]] = []
        for row in ((e.path, e.length, e.time) for e in walk(partition.folder)) if partition.folder else partition.files:
            held.append(row)
            if len(held) == _BATCH:
                yield _batch(held)
                held = []
        yield _batch(held)


def _batch(rows: list[tuple[str, int, float]]) -> pa.RecordBatch:
    times = [dt.datetime.fromtimestamp(int(t * 1000) / 1000, dt.timezone.utc) for _, _, t in rows]  # file systems agree on milliseconds
    return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in rows], pa.string()), pa.array([n for _, n, _ in rows], pa.int64()),
                                       pa.array(times, pa.timestamp("us", tz="UTC"))], schema=_ROWS)


def qualified(spark: SparkSession, root: str) -> str:
    """A root with its scheme: one without is a path of the cluster's default file system."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", root):
        return root
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def can_list(root: str) -> bool:
    """Whether this source reaches the root (a glob, or a scheme that Arrow does not know, is left to Spark)."""
    try:
        look(root)
        return True
    except Exception:  # noqa: BLE001 - Spark's own listing then raises what is to be raised
        return False


def list_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``path, length, modification_time`` of all files below the roots."""
    ship_package(spark)
    spark.dataSource.register(FileListing)
    return spark.read.format(FileListing.name()).option("roots", json.dumps([qualified(spark, r) for r in roots])).load()
