"""Directory trees as a corpus.

Discovery is a Spark job per level of the tree: each level's directories are
spread over the executors, and what they list is written to the workspace, so
that a lost executor costs a task and not the walk. Sizes are looked up in a
second step that is spread by path, because one directory may hold most of the
files. Paths travel as bytes and may hold any file name. The tree has to be
mounted on all executors; ``stores`` reads other storage. A large file is read
in pieces that end between tokens, so a row stays bounded and no text is left out.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.classify import ELIGIBLE, status_of
from wordloom.operators.sizing import TASK_BYTES
from wordloom.schemas import INVENTORY
from wordloom.sources.pieces import PIECE_BYTES, pieces
from wordloom.sources.workspace import new_location

#: Rows, and bytes of file content, that leave a Python worker in one batch.
BATCH_ROWS = 10_000
BATCH_BYTES = 16 * 1024 * 1024

#: Entries one task looks up.
ENTRIES_PER_TASK = 20_000

#: Entries up to which the driver walks a tree instead of starting jobs for it.
WALKED_ENTRIES = 10_000

_LISTED = pa.schema([("path", pa.binary()), ("kind", pa.string()), ("error", pa.string())])
_SIZED = pa.schema([("path", pa.binary()), ("size_bytes", pa.int64()), ("error", pa.string())])
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


def _ddl(schema: pa.Schema) -> str:
    names = {pa.binary(): "binary", pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pack rows into batches bounded in rows and in bytes."""
    held: list[tuple] = []
    held_bytes = 0

    def pack() -> pa.RecordBatch:
        columns = [list(column) for column in zip(*held)]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema)],
            schema=schema,
        )

    for row in rows:
        held.append(row)
        held_bytes += sum(len(value) for value in row if isinstance(value, bytes))
        if len(held) >= BATCH_ROWS or held_bytes >= BATCH_BYTES:
            yield pack()
            held, held_bytes = [], 0
    if held:
        yield pack()


def _reason(error: OSError) -> str:
    return f"{type(error).__name__}: {error.strerror}"


def _entries(base: bytes, directory: bytes) -> Iterator[tuple]:
    """What a directory holds. One without permission is passed over."""
    try:
        with os.scandir(os.path.join(base, directory)) as found:
            for entry in found:
                try:
                    nested = entry.is_dir(follow_symlinks=False)
                except OSError:
                    nested = False
                path = os.path.join(directory, entry.name)
                yield path, "directory" if nested else "entry", None
    except PermissionError:
        return
    except OSError as error:
        yield directory, "unlisted", _reason(error)


def _list_directories(base: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = (path for batch in batches for path in batch.column("path").to_pylist())
        return _batches((row for path in paths for row in _entries(base, path)), _LISTED)

    return run


def _sized(base: bytes, rows: Iterable[dict]) -> Iterator[tuple]:
    """Sizes of regular files. Links are followed; other kinds of entry drop out."""
    for row in rows:
        path = row["path"]
        if row["kind"] == "unlisted":
            yield path, None, row["error"]
            continue
        try:
            found = os.stat(os.path.join(base, path))
        except OSError as error:
            yield path, None, _reason(error)
            continue
        if stat.S_ISREG(found.st_mode):
            yield path, found.st_size, None


def _look_up(base: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        return _batches(_sized(base, rows), _SIZED)

    return run


def _read_files(base: bytes, piece_bytes: int):
    """Content of eligible files. A file that cannot be read keeps the reason.

    A failure after the first piece ends the file with a row that holds the
    reason instead of text, which takes back the pieces before it.
    """

    def contents(rows: Iterable[dict]) -> Iterator[tuple]:
        for row in rows:
            told = row["path"], row["size_bytes"], row["status"]
            if row["status"] != ELIGIBLE or row["error"] is not None:
                yield *told, row["error"], None, 0
                continue
            number = -1
            try:
                with open(os.path.join(base, row["path"]), "rb") as file:
                    for number, content in enumerate(pieces(file, piece_bytes)):
                        yield *told, None, content, number
            except OSError as failure:
                yield *told, _reason(failure), None, number + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        return _batches(contents(rows), _READ)

    return run


def _tasks(spark: SparkSession, units: float) -> int:
    return max(1, spark.sparkContext.defaultParallelism, int(units))


def _validated(root: str) -> None:
    if not os.path.exists(root):
        raise ValueError(f"no such directory: {root}")
    if not os.path.isdir(root):
        raise ValueError(f"not a directory: {root}")


def list_levels(
    spark: SparkSession, first: bytes, lister: Callable, schema: pa.Schema, location: str
) -> tuple[DataFrame, int]:
    """All entries below ``first`` that are not directories, and their number.

    ``lister`` turns paths of directories into rows (path, kind, ...) of what
    they hold. What the executors list is written to ``location``, level by level.
    """
    level_rows = spark.createDataFrame([(bytearray(first),)], "path binary")
    directories, total = 1, 0
    levels: list[str] = []
    while directories:
        levels.append(f"{location}/level={len(levels)}")
        tasks = min(directories, _tasks(spark, directories / 1000))
        (
            level_rows.repartition(tasks, "path")
            .mapInArrow(lister, _ddl(schema))
            .write.parquet(levels[-1])
        )
        listed = spark.read.schema(_ddl(schema)).parquet(levels[-1])
        nested = F.col("kind") == "directory"
        counts = listed.agg(F.count("*").alias("all"), F.count_if(nested).alias("nested")).first()
        level_rows = listed.where(nested).select("path")
        directories = counts["nested"]
        total += counts["all"] - directories
    listed = spark.read.schema(_ddl(schema)).parquet(*levels)
    return listed.where(F.col("kind") != "directory"), total


def list_tree(spark: SparkSession, root: str, location: str) -> tuple[DataFrame, int]:
    """All entries below ``root`` that are not directories, and their number."""
    base = os.fsencode(os.getcwd())
    return list_levels(spark, os.fsencode(root), _list_directories(base), _LISTED, location)


def _walked(root: str) -> list[tuple] | None:
    """Sizes of the regular files below ``root``, or None if there are too many entries."""
    base = os.fsencode(os.getcwd())
    waiting, entries = [os.fsencode(root)], []
    while waiting:
        for path, kind, error in _entries(base, waiting.pop()):
            if kind == "directory":
                waiting.append(path)
            entries.append({"path": path, "kind": kind, "error": error})
            if len(entries) > WALKED_ENTRIES:
                return None
    return list(_sized(base, (row for row in entries if row["kind"] != "directory")))


def inventory(
    spark: SparkSession,
    root: str,
    max_bytes: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """Every regular file below ``root``, classified but not opened.

    Directories and other entries that are not regular files are left out; an
    entry whose kind or size cannot be read is inaccessible. The tree is looked
    at once: the driver lists a small one itself, and what executors list of a
    larger one is stored at ``location``.
    """
    _validated(root)
    walked = _walked(root)
    if walked is not None:
        rows = [(bytearray(path), size, error) for path, size, error in walked]
        listed = spark.createDataFrame(rows, _ddl(_SIZED)).withColumn("path", F.col("path").cast("string"))
        return listed.select("path", "size_bytes", status_of("path", "size_bytes", max_bytes).alias("status"), "error")
    location = location or new_location(spark, "scan")
    entries, number = list_tree(spark, root, f"{location}/entries")
    base = os.fsencode(os.getcwd())
    sized = (
        entries.repartition(_tasks(spark, number / ENTRIES_PER_TASK), "path")
        .mapInArrow(_look_up(base), _ddl(_SIZED))
        .withColumn("path", F.col("path").cast("string"))
    )
    sized.select(
        "path",
        "size_bytes",
        status_of("path", "size_bytes", max_bytes).alias("status"),
        "error",
    ).write.parquet(f"{location}/inventory")
    return spark.read.schema(INVENTORY).parquet(f"{location}/inventory")


def with_text(spark: SparkSession, files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Open the eligible files of an inventory; the others pass through.

    The reading tasks are sized by the bytes they read, and a large file is a
    row per piece. Bytes become text as ISO-8859-1, which maps every byte to one
    character and so cannot fail.
    """
    base = os.fsencode(os.getcwd())
    size = F.when(F.col("status") == ELIGIBLE, F.col("size_bytes"))
    total = files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    return (
        files.withColumn("path", F.col("path").cast("binary"))
        .repartition(_tasks(spark, total / TASK_BYTES), "path")
        .mapInArrow(_read_files(base, piece_bytes), _ddl(_READ))
        .select(
            F.col("path").cast("string").alias("path"),
            "size_bytes",
            "status",
            "error",
            F.decode("content", "ISO-8859-1").alias("text"),
            "piece",
        )
    )


def corpus_from_tree(
    spark: SparkSession,
    root: str,
    max_bytes: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """The files below ``root`` as a corpus, with the text of eligible files."""
    return with_text(spark, inventory(spark, root, max_bytes, location))


def corpus_from_store(
    spark: SparkSession, root: str, max_bytes: int | None = None
) -> DataFrame:
    """Eligible files from any storage Spark can list, such as an object store.

    Spark's own reader lists the files here. It leaves out empty files and
    names that begin with ``_`` or ``.``, and it does not report what it leaves
    out, so this is a choice for trees without such files; ``corpus_from_tree``
    is exact. The size limit is pushed down to the listing.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{[tT][xX][tT],[mM][dD],[lL][oO][gG],[cC][sS][vV]}")
        .load(root)
    )
    if max_bytes is not None:
        files = files.where(F.col("length") <= max_bytes)
    path = F.regexp_replace("path", "^file:/+", "/")
    return files.select(
        path.alias("path"),
        F.col("length").alias("size_bytes"),
        status_of(path, F.col("length"), max_bytes).alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.decode("content", "ISO-8859-1").alias("text"),
        F.lit(0).alias("piece"),
    )
