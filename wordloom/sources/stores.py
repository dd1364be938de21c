"""Files of any storage as a corpus, through the storage's own interface.

Nothing has to be mounted: directories are listed and ranges of files are read
by ``pyarrow.fs`` on the executors, so empty files and names that begin with
``_`` or ``.`` are there like all others. What is to be read is planned first.
Executors list level by level, then pack the entries into plan files of about
one task's bytes, with large files cut into ranges; the reader of the data
source makes a partition of each plan file. The driver handles names of plan
files only, one for every task.
"""

from __future__ import annotations

import os
import re
import stat
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from wordloom.functions.text import SUPPORTED_PATTERN
from wordloom.operators.classify import ELIGIBLE, INACCESSIBLE, SKIPPED
from wordloom.operators.sizing import TASK_BYTES
from wordloom.sources.pieces import PIECE_BYTES, pieces
from wordloom.sources.trees import ENTRIES_PER_TASK, _batches, _ddl, list_levels
from wordloom.sources.workspace import new_location

#: Bytes of a file that one partition reads; a larger file is read by several.
RANGE_BYTES = 64 * 1024 * 1024
#: Smallest partition that is planned while there are cores without one.
LEAST_TASK_BYTES = 1024 * 1024

_SUPPORTED = re.compile(SUPPORTED_PATTERN.replace(r"\z", r"\Z"))

_FOUND = pa.schema([("path", pa.binary()), ("kind", pa.string()), ("size_bytes", pa.int64()), ("error", pa.string())])
_PLANNED = pa.schema(
    [
        ("path", pa.binary()),
        ("size_bytes", pa.int64()),
        ("status", pa.string()),
        ("error", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
    ]
)
_READ = pa.schema(
    [
        ("path", pa.binary()),
        ("size_bytes", pa.int64()),
        ("status", pa.string()),
        ("error", pa.string()),
        ("content", pa.binary()),
        ("piece", pa.int32()),
    ]
)


def _reason(error: Exception) -> str:
    told = error.strerror if isinstance(error, OSError) and error.strerror else str(error)
    return f"{type(error).__name__}: {told}"


class Mounted:
    """A folder of the machine. Links to files are followed, links to directories are not."""

    def __init__(self, base: str):
        self._base = os.fsencode(base)

    def children(self, directory: bytes) -> Iterator[tuple]:
        try:
            with os.scandir(os.path.join(self._base, directory)) as found:
                for entry in found:
                    yield from self._child(os.path.join(directory, entry.name), entry)
        except PermissionError:
            return
        except OSError as error:
            yield directory, "unlisted", None, _reason(error)

    def _child(self, path: bytes, entry: os.DirEntry) -> Iterator[tuple]:
        try:
            if entry.is_dir(follow_symlinks=False):
                yield path, "directory", None, None
                return
            told = entry.stat()
        except OSError as error:
            yield path, "file", None, _reason(error)
            return
        if stat.S_ISREG(told.st_mode):
            yield path, "file", told.st_size, None

    def open(self, path: bytes) -> BinaryIO:
        return open(os.path.join(self._base, path), "rb")


class Remote:
    """A folder of a file system of ``pyarrow.fs``, such as a bucket and prefix."""

    def __init__(self, files: fs.FileSystem, base: str):
        self._files, self._base = files, base.rstrip("/")

    def _place(self, path: bytes) -> str:
        return f"{self._base}/{path.decode()}" if path else self._base

    def children(self, directory: bytes) -> Iterator[tuple]:
        try:
            found = self._files.get_file_info(fs.FileSelector(self._place(directory)))
        except PermissionError:
            return
        except (OSError, ValueError) as error:
            yield directory, "unlisted", None, _reason(error)
            return
        for one in found:
            path = os.path.join(directory, one.base_name.encode())
            if one.type == fs.FileType.Directory:
                yield path, "directory", None, None
            elif one.type == fs.FileType.File:
                yield path, "file", one.size, None
            elif one.type == fs.FileType.NotFound:
                yield path, "file", None, "FileNotFoundError: gone since it was listed"

    def open(self, path: bytes) -> BinaryIO:
        return self._files.open_input_file(self._place(path))


def _absolute(root: str) -> str:
    return root if "://" in root else os.path.abspath(root)


def storage(root: str) -> Mounted | Remote:
    """The folder that an absolute path or URI names."""
    files, base = fs.FileSystem.from_uri(root)
    return Mounted(base) if isinstance(files, fs.LocalFileSystem) else Remote(files, base)


def _validated(root: str) -> None:
    files, base = fs.FileSystem.from_uri(root)
    kind = files.get_file_info(base).type
    if kind == fs.FileType.NotFound:
        raise ValueError(f"no such directory: {root}")
    if kind != fs.FileType.Directory:
        raise ValueError(f"not a directory: {root}")


def _lister(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = storage(root)
        paths = (path for batch in batches for path in batch.column("path").to_pylist())
        return _batches((row for path in paths for row in opened.children(path)), _FOUND)

    return run


def _status(path: bytes, size: int | None, max_bytes: int | None) -> str:
    if size is None:
        return INACCESSIBLE
    small = max_bytes is None or size <= max_bytes
    # Bytes map to characters one to one, which leaves the suffix as it is.
    return ELIGIBLE if small and _SUPPORTED.search("/" + path.decode("latin-1")) else SKIPPED


def _ranges(size: int, range_bytes: int) -> Iterator[tuple[int, int | None]]:
    """Ranges of a file. The last one has no end, so it takes what was added since."""
    for start in range(0, max(size, 1), range_bytes):
        stop = start + range_bytes
        yield start, stop if stop < size else None


def _planner(location: str, max_bytes: int | None, task_bytes: int, range_bytes: int):
    """Write plan files of about ``task_bytes`` each and tell their names."""

    def entries(rows: Iterable[dict]) -> Iterator[tuple[int, tuple]]:
        for row in rows:
            path, size = row["path"], row["size_bytes"]
            status = _status(path, size, max_bytes)
            if status != ELIGIBLE:
                yield 0, (path, size, status, row["error"], 0, None)
                continue
            for start, stop in _ranges(size, range_bytes):
                yield (stop or size) - start, (path, size, status, None, start, stop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(location)
        held: list[tuple] = []
        held_bytes, names = 0, []

        def close() -> None:
            nonlocal held, held_bytes
            names.append(f"{uuid.uuid4().hex}.parquet")
            columns = [pa.array(list(column), field.type) for column, field in zip(zip(*held), _PLANNED)]
            with files.open_output_stream(f"{folder}/{names[-1]}") as out:
                pq.write_table(pa.Table.from_arrays(columns, schema=_PLANNED), out)
            held, held_bytes = [], 0

        for size, entry in entries(row for batch in batches for row in batch.to_pylist()):
            held.append(entry)
            held_bytes += size
            if held_bytes >= task_bytes or len(held) >= ENTRIES_PER_TASK:
                close()
        if held:
            close()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names)], ["plan"])

    return run


def plan(
    spark: SparkSession,
    root: str,
    max_bytes: int | None = None,
    location: str | None = None,
    task_bytes: int = TASK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> str:
    """List the storage once and plan how it is read; returns where the plan is.

    A plan lists every file, those that are not opened included. The names of its
    files are stored with it: a planning task that is run again leaves files that
    no partition reads.
    """
    root = _absolute(root)
    _validated(root)
    location = location or new_location(spark, "plan")
    found, number = list_levels(spark, b"", _lister(root), _FOUND, f"{location}/entries")
    total = found.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")).first()["bytes"]
    cores = spark.sparkContext.defaultParallelism
    task_bytes = max(min(task_bytes, total // cores), min(task_bytes, LEAST_TASK_BYTES))
    files, folder = fs.FileSystem.from_uri(location)
    files.create_dir(f"{folder}/plans", recursive=True)
    tasks = max(1, number // ENTRIES_PER_TASK)
    (
        found.repartition(tasks, "path")
        .mapInArrow(_planner(f"{location}/plans", max_bytes, task_bytes, min(range_bytes, task_bytes)), "plan string")
        .write.parquet(f"{location}/names")
    )
    return location


@dataclass
class Planned(InputPartition):
    """A partition of the data source: one plan file."""

    name: str


class CorpusFiles(DataSource):
    """``format("corpus_files")``: rows of the files of a plan.

    Options: ``path``, the root; ``plan``, what ``plan`` returned;
    ``piece_bytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "corpus_files"

    def schema(self) -> str:
        return _ddl(_READ)

    def reader(self, schema: StructType) -> DataSourceReader:
        return CorpusReader(self.options)


class CorpusReader(DataSourceReader):
    def __init__(self, options: dict):
        self._root, self._plan = options["path"], options["plan"]
        self._piece_bytes = int(options.get("piece_bytes", PIECE_BYTES))

    def partitions(self) -> list[InputPartition]:
        files, folder = fs.FileSystem.from_uri(f"{self._plan}/names")
        names = pq.read_table(folder, filesystem=files).column("plan").to_pylist()
        return [Planned(name) for name in sorted(names)] or [Planned("")]

    def read(self, partition: Planned) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return iter(())
        files, folder = fs.FileSystem.from_uri(f"{self._plan}/plans")
        planned = pq.read_table(f"{folder}/{partition.name}", filesystem=files).to_pylist()
        return _batches(read_planned(storage(self._root), planned, self._piece_bytes), _READ)


def read_planned(opened: Mounted | Remote, planned: Iterable[dict], piece_bytes: int) -> Iterator[tuple]:
    """Rows of the ranges of a plan file.

    The first piece of a file, and no other, is number 0.
    A range that cannot be read, or not to its end, ends with a row that holds
    the reason instead of text. Such a row takes back all pieces of the file.
    """
    for row in planned:
        told = row["path"], row["size_bytes"], row["status"]
        if row["status"] != ELIGIBLE:
            yield *told, row["error"], None, 0
            continue
        number = row["start"] // piece_bytes + bool(row["start"])
        try:
            with opened.open(row["path"]) as file:
                for content in pieces(file, piece_bytes, row["start"], row["stop"]):
                    yield *told, None, content, number
                    number += 1
        except (OSError, pa.ArrowException) as failure:
            yield *told, _reason(failure), None, number


def corpus_from_uri(
    spark: SparkSession,
    root: str,
    max_bytes: int | None = None,
    location: str | None = None,
    piece_bytes: int = PIECE_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The files below a path or URI as a corpus, with the text of eligible files.

    Every regular file is a row, empty ones and hidden names included; a file
    that cannot be listed or read keeps the reason. Paths are the root as typed
    and what follows below it. The storage is listed once, here. Bytes become
    text as ISO-8859-1, which maps every byte to one character.
    """
    spark.dataSource.register(CorpusFiles)
    planned = plan(spark, root, max_bytes, location, range_bytes=range_bytes)
    rows = (
        spark.read.format("corpus_files")
        .option("plan", planned)
        .option("piece_bytes", piece_bytes)
        .load(_absolute(root))
    )
    before = root if root.endswith("/") else f"{root}/"
    return rows.select(
        F.concat(F.lit(before).cast("binary"), "path").cast("string").alias("path"),
        "size_bytes",
        "status",
        "error",
        F.decode("content", "ISO-8859-1").alias("text"),
        "piece",
    )
