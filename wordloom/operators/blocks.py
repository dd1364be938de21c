"""A compact form of an index, in blocks of postings.

Files get dense numbers in the order of their paths, and paths are stored once.
The postings of a word are cut into blocks of consecutive files; a block is a row
with the sorted places of its files and their frequencies, which Parquet stores
as bit-packed differences. A row also tells the greatest frequency in it, so a
search for the best few files can leave out blocks that cannot hold one of them
without reading their postings.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions.text import query_words
from wordloom.operators.search import any_of, ranked
from wordloom.operators.sizing import fits_broadcast
from wordloom.schemas import RESULTS

#: Files of a block. Their places in it fit 16 bits.
BLOCK_FILES = 1 << 16
#: Blocks that the first round of a search reads; each further round reads four times as many.
FIRST_BLOCKS = 16
#: Blocks up to which a reader is told their numbers one by one.
_LISTED_BLOCKS = 64

# Options of Parquet that store numbers as bit-packed differences.
_PACKED = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false", "compression": "zstd"}

_BLOCKS = "word string, first bigint, most bigint, places array<int>, frequencies array<bigint>"
_NUMBERED = "number bigint, path string, size_bytes bigint, token_count bigint, outcome string, error string"


def number_files(files: DataFrame, location: str) -> DataFrame:
    """Files with dense numbers from 0 in path order, stored below ``location``.

    Paths are cut into ranges and sorted inside them; the row counts of the
    ranges give where the numbers of each begin.
    """
    spark = files.sparkSession
    row = F.monotonically_increasing_id()
    (
        files.repartitionByRange("path")
        .sortWithinPartitions("path")
        .select("*", F.shiftright(row, 33).alias("range"), row.bitwiseAND((1 << 33) - 1).alias("place"))
        .write.parquet(f"{location}/ranges")
    )
    ranges = spark.read.parquet(f"{location}/ranges")
    before = F.sum("rows").over(Window.orderBy("range")) - F.col("rows")
    # One row per range, that is per task of the sort.
    starts = ranges.groupBy("range").agg(F.count("*").alias("rows")).select("range", before.alias("before"))
    (
        ranges.join(F.broadcast(starts), "range")
        .select((F.col("before") + F.col("place")).alias("number"), *files.columns)
        .repartitionByRange("number")
        .sortWithinPartitions("number")
        .write.option("compression", "zstd")
        .parquet(f"{location}/files")
    )
    return numbered_files(spark, location)


def numbered_files(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(_NUMBERED).parquet(f"{location}/files")


def stored_blocks(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{location}/blocks")


def write_blocks(index: DataFrame, files: DataFrame, location: str, block_files: int = BLOCK_FILES) -> None:
    """Store postings (word, path, frequency) and the rows of all files in blocks.

    A block holds at most ``block_files`` postings, so no row grows with the
    list of a frequent word, and its blocks are dealt like those of other words.
    """
    numbers = number_files(files, location).select("path", "number")
    numbers = F.broadcast(numbers) if fits_broadcast(numbers) else numbers
    first = F.col("number") - F.col("number") % block_files
    (
        index.join(numbers, "path")
        .select("word", first.alias("first"), (F.col("number") - first).cast("int").alias("place"), "frequency")
        .groupBy("word", "first")
        .agg(F.max("frequency").alias("most"), F.sort_array(F.collect_list(F.struct("place", "frequency"))).alias("postings"))
        .select("word", "first", "most", F.col("postings.place").alias("places"), F.col("postings.frequency").alias("frequencies"))
        .repartitionByRange("word", "first")
        .sortWithinPartitions("word", "first")
        .write.options(**_PACKED)
        .parquet(f"{location}/blocks")
    )


def _opened(blocks: DataFrame) -> DataFrame:
    """One row (word, number, frequency) per posting."""
    posting = F.explode(F.arrays_zip("places", "frequencies")).alias("posting")
    return blocks.select("word", "first", posting).select(
        "word", (F.col("first") + F.col("posting.places")).alias("number"), F.col("posting.frequencies").alias("frequency")
    )


def block_postings(spark: SparkSession, location: str) -> DataFrame:
    """The index again as (word, path, frequency)."""
    files = numbered_files(spark, location).select("number", "path")
    return _opened(stored_blocks(spark, location)).join(files, "number").select("word", "path", "frequency")


@dataclass
class Best:
    """What a search found and what it read for it."""

    results: DataFrame
    blocks: int = 0
    blocks_read: int = 0
    rounds: list[int] = field(default_factory=list)


def _among(numbers: list[int]) -> Column:
    return any_of([int(n) for n in numbers], "first")


def search_best(spark: SparkSession, location: str, query: str, limit: int) -> Best:
    """The ``limit`` best files of a query: the rows of ``search``, reading only some blocks.

    First the greatest frequencies of all blocks of the terms are read, a number
    per block, without their postings. Added up over the terms they bound what a
    file of a block can score, and the greatest one is a score that some file of
    it reaches. Blocks are then read in the order of their bounds, in rounds,
    until no bound is left that reaches the score of the last file found. A file
    that only ties with it can still come first by path, so ties are read too.
    What reaches the driver is a row per block of the terms, that is per 65,536
    files, and ``limit`` rows per round.
    """
    words = sorted(query_words(query))
    if not words or limit <= 0:
        return Best(spark.createDataFrame([], RESULTS))
    blocks = stored_blocks(spark, location).where(any_of(words))
    heads = blocks.groupBy("first").agg(F.sum("most").alias("bound"), F.max("most").alias("reached")).collect()
    firsts = np.array([row["first"] for row in heads], np.int64)
    bounds = np.array([row["bound"] for row in heads], np.int64)
    reached = np.sort(np.array([row["reached"] for row in heads], np.int64))[::-1]
    # Blocks hold different files, so this many files score this much or more.
    threshold = int(reached[limit - 1]) if len(reached) >= limit else 0
    order = np.lexsort((firsts, -bounds))
    best: list[tuple[int, int, int]] = []
    found = Best(spark.createDataFrame([], RESULTS), blocks=len(heads))
    at, size = 0, FIRST_BLOCKS
    while at < len(order) and bounds[order[at]] >= threshold:
        some = [one for one in order[at : at + size].tolist() if bounds[one] >= threshold]
        numbers = firsts[some].tolist()
        if len(numbers) <= _LISTED_BLOCKS:
            read = blocks.where(_among(numbers))
        else:
            table = spark.createDataFrame([(n,) for n in numbers], "first bigint")
            read = blocks.join(F.broadcast(table), "first", "left_semi")
        scored = _opened(read).groupBy("number").agg(F.sum("frequency").alias("score"), F.count("*").alias("terms"))
        rows = scored.orderBy(F.desc("score"), "number").limit(limit).collect()
        best = sorted(best + [(-row["score"], row["number"], row["terms"]) for row in rows])[:limit]
        if len(best) == limit:
            threshold = max(threshold, -best[-1][0])
        found.blocks_read += len(numbers)
        found.rounds.append(len(numbers))
        at, size = at + size, size * 4
    if best:
        files = numbered_files(spark, location).where(any_of([number for _, number, _ in best], "number"))
        scores = spark.createDataFrame([(number, -less, terms) for less, number, terms in best], "number bigint, score bigint, matched_terms bigint")
        found.results = ranked(
            files.join(F.broadcast(scores), "number").select(
                "path", "score", F.col("score").alias("total_matches"), "matched_terms"
            )
        )
    return found
