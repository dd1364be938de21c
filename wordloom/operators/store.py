"""Saving a ledger as the stored index, and reading it back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.directory import entries_of, entries_of_terms, file_entries, write_directory
from wordloom.operators.postings import file_rows, posting_rows, settled, uncommitted
from wordloom.operators.ranges import in_ranges
from wordloom.schemas import LEDGER, WITHDRAWN
from wordloom.sources.workspace import exists


def write_index(entries: DataFrame, location: str, bounds: Sequence[str] = ()) -> None:
    """Write a ledger as Parquet, clustered by word.

    Ranges are cut on (word, path), so a frequent word is split over as many
    files as its postings need. The sort gives every row group a narrow word
    range: a lookup reads the row groups that can hold its words, of the files
    that the term directory names. The rows of files have no word and come first,
    in row groups of their own. With ``bounds`` of a sample the rows are computed
    once; without, Spark computes them once more to find where to cut.
    """
    dealt = in_ranges(entries, list(bounds)) if bounds else entries.repartitionByRange("word", "path")
    (
        dealt.sortWithinPartitions("word", "path")
        .write.option("compression", "zstd")
        .mode("errorifexists")
        .parquet(location)
    )
    write_directory(entries.sparkSession, location)


def _withdrawn_at(location: str) -> str:
    # Spark leaves out names that begin like this when it reads the entries.
    return f"{location}/_withdrawn"


def withdraw(spark: SparkSession, location: str) -> None:
    """Take back the rows of files that were not read to their end.

    The index keeps their rows and, next to them, a table of their paths, so that
    a file that fails after hours costs no second build. A path that stands for
    more than one file is refused.
    """
    late = uncommitted(file_entries(spark, location))
    told = late.agg(F.max(F.when(F.col("files") > 1, F.col("path"))).alias("repeated"), F.count("*").alias("late")).first()
    if told["repeated"] is not None:
        raise ValueError(f"a path occurs more than once: {told['repeated']}")
    if told["late"]:
        late.select(*WITHDRAWN.names).write.mode("errorifexists").parquet(_withdrawn_at(location))


def committed(spark: SparkSession, location: str, entries: DataFrame) -> DataFrame:
    """Entries of a stored index without those that were taken back."""
    if not exists(spark, _withdrawn_at(location)):
        return entries
    return settled(entries, spark.read.schema(WITHDRAWN).parquet(_withdrawn_at(location)))


def stored_ledger(spark: SparkSession, location: str) -> DataFrame:
    return committed(spark, location, spark.read.schema(LEDGER).parquet(location))


def stored_files(spark: SparkSession, location: str) -> DataFrame:
    """The rows of files, from the index files that hold such rows."""
    return file_rows(committed(spark, location, file_entries(spark, location)))


def stored_postings(spark: SparkSession, location: str, words: Iterable[str]) -> DataFrame:
    """Postings from the index files that can hold these words."""
    return posting_rows(committed(spark, location, entries_of(spark, location, words)))


def stored_postings_of(spark: SparkSession, location: str, terms: DataFrame) -> DataFrame:
    """Postings from the index files that can hold a word of a table of terms."""
    return posting_rows(committed(spark, location, entries_of_terms(spark, location, terms)))
