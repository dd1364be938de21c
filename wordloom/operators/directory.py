"""The term directory: which files of a stored index can hold a word.

An index is sorted by word, so each of its files covers a range of words. The
directory has a row per file with the first and last word in it, taken from the
file's own statistics. A search asks it first and then opens only the files that
can hold its words, where it otherwise would open all of them to find that most
hold nothing.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.schemas import DIRECTORY, LEDGER

#: Index files whose statistics one task reads.
FILES_PER_TASK = 200


def _place(location: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(location)


def _directory_at(location: str) -> str:
    # Spark leaves out names that begin like this when it reads the entries.
    return f"{location}/_directory"


def _told(location: str, names: Iterable[str]) -> Iterator[tuple]:
    """First and last word, words and missing words of index files, from their footers.

    A writer leaves the statistics of very long words out. Where they are missing
    the words of that row group are read instead.
    """
    files, folder = _place(location)
    for name in names:
        with files.open_input_file(f"{folder}/{name}") as opened:
            file = pq.ParquetFile(opened)
            at = file.schema.names.index("word")
            firsts, lasts, words, missing = [], [], 0, 0
            for number in range(file.metadata.num_row_groups):
                rows = file.metadata.row_group(number).num_rows
                told = file.metadata.row_group(number).column(at).statistics
                known = told is not None and told.has_null_count
                if known and (told.has_min_max or told.null_count == rows):
                    nulls, bounds = told.null_count, (told.min, told.max)
                else:
                    column = file.read_row_group(number, columns=["word"]).column(0)
                    found = pc.min_max(column).as_py()
                    nulls, bounds = column.null_count, (found["min"], found["max"])
                if nulls < rows:
                    firsts.append(bounds[0])
                    lasts.append(bounds[1])
                words, missing = words + rows - nulls, missing + nulls
        yield name, min(firsts, default=None), max(lasts, default=None), words, missing


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], DIRECTORY.names)


def _teller(location: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _packed(list(_told(location, batch.column(0).to_pylist())))

    return run


def write_directory(spark: SparkSession, location: str) -> None:
    """Make the directory of a stored index from footers, not rows.

    More files than one task would take are dealt to executors.
    """
    files, folder = _place(location)
    names = [
        one.base_name
        for one in files.get_file_info(fs.FileSelector(folder))
        if one.is_file and one.base_name.endswith(".parquet") and not one.base_name.startswith(("_", "."))
    ]
    if len(names) <= FILES_PER_TASK:
        rows = list(_told(location, names))
    else:
        table = spark.createDataFrame([(name,) for name in names], "file string")
        dealt = table.repartition(len(names) // FILES_PER_TASK, "file")
        rows = [tuple(row) for row in dealt.mapInArrow(_teller(location), DIRECTORY).collect()]
    rows.sort(key=lambda row: (row[1] is not None, row[1] or "", row[2] or "", row[0]))
    _, path = _place(_directory_at(location))
    files.create_dir(path)
    with files.open_output_stream(f"{path}/ranges.parquet") as out:
        pq.write_table(pa.Table.from_batches([_packed(rows)]), out)


def _read(location: str, columns: list[str]) -> dict[str, list]:
    """The directory itself: one short row per index file."""
    files, folder = _place(_directory_at(location))
    table = pq.read_table(folder, filesystem=files, columns=columns)
    return {name: table.column(name).to_pylist() for name in columns}


def _opened(spark: SparkSession, location: str, names: Iterable[str]) -> DataFrame:
    paths = [f"{location}/{name}" for name in sorted(set(names))]
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)


def entries_of(spark: SparkSession, location: str, words: Iterable[str]) -> DataFrame:
    """The index files that can hold one of these words."""
    wanted = sorted(set(words))
    told = _read(location, ["file", "first_word", "last_word"])
    names = []
    for name, first, last in zip(told["file"], told["first_word"], told["last_word"]):
        if first is not None:
            at = bisect.bisect_left(wanted, first)
            if at < len(wanted) and wanted[at] <= last:
                names.append(name)
    return _opened(spark, location, names)


def file_entries(spark: SparkSession, location: str) -> DataFrame:
    """The index files that hold rows of files, which have no word."""
    told = _read(location, ["file", "words_missing"])
    return _opened(spark, location, (name for name, n in zip(told["file"], told["words_missing"]) if n))


def _matcher(location: str):
    """Names of index files that can hold one of the words of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _read(location, ["file", "first_word", "last_word"])
        rows = [row for row in zip(told["first_word"], told["last_word"], told["file"]) if row[0] is not None]
        firsts, lasts = [row[0] for row in rows], [row[1] for row in rows]
        hit: set[int] = set()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                # Ranges follow one another and share no more than their ends.
                hit.update(range(bisect.bisect_left(lasts, word), bisect.bisect_right(firsts, word)))
        if hit:
            yield pa.RecordBatch.from_arrays([pa.array([rows[at][2] for at in sorted(hit)])], ["file"])

    return run


def entries_of_terms(spark: SparkSession, location: str, terms: DataFrame) -> DataFrame:
    """The index files that can hold a word of a whole table of terms.

    Terms are matched with the ranges where they are; what reaches the driver is
    at most one name per index file.
    """
    words = terms.select("word").where(F.col("word").isNotNull()).distinct()
    found = words.mapInArrow(_matcher(location), "file string").distinct().collect()
    return _opened(spark, location, (row["file"] for row in found))
