"""The ledger of whole texts and of pieces of files, counted text by text where they are.

Exploded, every token is a row that passes two hash tables before it is a part of
a posting. A text that is in one piece has all its postings in itself, so a task
counts it as a whole, sorts what it counted and tells the range of every row. The
ranges are then sorted from runs that are in order already.
"""

from __future__ import annotations

import io
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.classify import INDEXED, outcome_of
from wordloom.operators.postings import ledger
from wordloom.operators.ranges import ranged
from wordloom.operators.sizing import fits_broadcast
from wordloom.schemas import LEDGER
from wordloom.sources.pieces import pieces

#: Largest text that is counted as a whole. Longer ones are cut into pieces.
WHOLE_BYTES = 1024 * 1024

#: Postings that a task holds before it sorts them, and rows that leave it in one batch.
HELD_POSTINGS, BATCH_ROWS = 1_000_000, 65_536

# Fixed value: the bytes that tokens are made of.
_TOKEN = re.compile(rb"[0-9A-Za-z]+")

_RANGED = pa.schema(
    [
        ("word", pa.string()),
        ("path", pa.string()),
        ("frequency", pa.int64()),
        ("size_bytes", pa.int64()),
        ("token_count", pa.int64()),
        ("outcome", pa.string()),
        ("error", pa.string()),
        ("range", pa.int32()),
    ]
)
_DDL = (
    "word string, path string, frequency bigint, size_bytes bigint, "
    "token_count bigint, outcome string, error string, range int"
)


def counted_apart(path: Column | str, size_bytes: Column) -> Column:
    """Rows that are not counted as a whole: long texts, and rows without a path, which are one file."""
    return (F.col(path) if isinstance(path, str) else path).isNull() | (F.coalesce(size_bytes, F.lit(0)) > WHOLE_BYTES)


def _ranks(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each value among the values in order, and the values in order."""
    order = pc.sort_indices(values)
    ranks = np.empty(len(values), np.int64)
    ranks[order.to_numpy()] = np.arange(len(values))
    return ranks, values.take(order)


def _file_rows(files: list[tuple], bounds: Sequence[bytes]) -> pa.RecordBatch:
    files = sorted(files, key=lambda row: (row[0] is not None, row[0]))
    paths, sizes, counts, outcomes, errors, firsts = zip(*files)
    n = len(files)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.string()),
            pa.array(paths, pa.binary()).cast(pa.string()),
            pa.array(firsts, pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array(outcomes, pa.string()),
            pa.array(errors, pa.string()),
            pa.array([bisect_right(bounds, b"\0" + (path or b"")) for path in paths], pa.int32()),
        ],
        schema=_RANGED,
    )


def _posting_rows(
    files: list[tuple], words: list[bytes], counts: list[int], sizes: list[int], bounds: Sequence[bytes]
) -> Iterator[pa.RecordBatch]:
    """Postings in the order of (word, path), with the number of bounds that do not come after each."""
    found = pa.array(words, pa.large_binary()).dictionary_encode()
    word_ranks, distinct = _ranks(found.dictionary)
    path_ranks, paths = _ranks(pa.array([row[0] for row in files], pa.binary()))
    keys = word_ranks[found.indices.to_numpy()] * len(paths) + np.repeat(path_ranks, sizes)
    order = np.argsort(keys, kind="stable")
    keys, frequencies = keys[order], np.array(counts, np.int64)[order]
    known, told = distinct.to_pylist(), paths.to_pylist()
    starts = []
    for bound in bounds:
        word, _, path = bound.partition(b"\0")
        place = bisect_left(known, word)
        inside = place < len(known) and known[place] == word
        starts.append(place * len(paths) + (bisect_left(told, path) if inside else 0))
    ranges = np.searchsorted(np.array(starts, np.int64), keys, side="right").astype(np.int32)
    distinct, paths = distinct.cast(pa.string()), paths.cast(pa.string())
    for at in range(0, len(keys), BATCH_ROWS):
        part = keys[at : at + BATCH_ROWS]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                distinct.take(pa.array(part // len(paths))),
                paths.take(pa.array(part % len(paths))),
                pa.array(frequencies[at : at + n]),
                *[pa.nulls(n, kind) for kind in (pa.int64(), pa.int64(), pa.string(), pa.string())],
                pa.array(ranges[at : at + n]),
            ],
            schema=_RANGED,
        )


def _words_of(text: bytes) -> Counter:
    if len(text) <= WHOLE_BYTES:
        return Counter(_TOKEN.findall(text.lower()))
    counted = Counter()
    for part in pieces(io.BytesIO(text), WHOLE_BYTES):
        counted.update(_TOKEN.findall(part.lower()))
    return counted


def _counter(bounds: Sequence[str]):
    held_bounds = [bound.encode() for bound in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[tuple] = []
        words: list[bytes] = []
        counts: list[int] = []
        sizes: list[int] = []

        def told() -> Iterator[pa.RecordBatch]:
            yield _file_rows(files, held_bounds)
            if words:
                yield from _posting_rows(files, words, counts, sizes, held_bounds)
            for held in (files, words, counts, sizes):
                held.clear()

        for batch in batches:
            for path, size, outcome, error, first, text in zip(*batch.columns):
                text = text.as_py()
                counted = _words_of(text or b"")
                files.append((path.as_py(), size.as_py(), counted.total(), outcome.as_py(), error.as_py(), int(first.as_py())))
                words.extend(counted)
                counts.extend(counted.values())
                sizes.append(len(counted))
                if len(words) >= HELD_POSTINGS:
                    yield from told()
        if files:
            yield from told()

    return run


def _counted(corpus: DataFrame, bounds: Sequence[str]) -> DataFrame:
    outcome = outcome_of()
    rows = corpus.select(
        F.col("path").cast("binary").alias("path"),
        "size_bytes",
        outcome.alias("outcome"),
        "error",
        F.coalesce(F.col("piece") == 0, F.lit(False)).alias("first"),
        F.when(outcome == INDEXED, F.col("text").cast("binary")).alias("text"),
    )
    return rows.mapInArrow(_counter(bounds), _DDL)


def counted_ledger(corpus: DataFrame, bounds: Sequence[str], apart: bool) -> DataFrame:
    """The rows of ``ledger`` with the number of the range that each is in.

    ``corpus`` has a text of at most ``WHOLE_BYTES`` as one row. With ``apart`` there
    may be rows that ``counted_apart`` tells; they are exploded, as in any corpus.
    The rows are then told apart after they were dealt, so that both kinds come from
    one reading of the texts and an executor never holds a long text twice.
    """
    alone = counted_apart("path", F.col("size_bytes"))
    if not apart:
        return _counted(corpus.where(~alone), bounds)
    # A filter on a column that is not deterministic stays above the shuffle.
    dealt = corpus.withColumn("dealt", F.spark_partition_id())
    here = F.col("dealt") >= 0
    rows = _counted(dealt.where(~alone & here), bounds)
    return rows.unionByName(ranged(ledger(dealt.where(alone & here)), list(bounds)))


def count_pieces(corpus: DataFrame, location: str) -> None:
    """Store what the rows of a corpus hold, each counted for itself where it is."""
    _counted(corpus, ()).drop("range").write.mode("errorifexists").parquet(location)


def ledger_of_pieces(spark: SparkSession, location: str) -> DataFrame:
    """The rows of ``ledger`` from what ``count_pieces`` stored.

    A file of one row is in the ledger as it was counted. Rows of other files, and of
    paths that occur more than once, are added up; if there are none, nothing is joined.
    """
    stored = spark.read.schema(LEDGER).parquet(location)
    several = stored.where(F.col("word").isNull()).groupBy("path").count().where(F.col("count") > 1)
    several = several.select(F.col("path").alias("of"))
    if several.isEmpty():
        return stored
    several = F.broadcast(several) if fits_broadcast(several) else several
    same = F.col("path").eqNullSafe(F.col("of"))
    file_columns = ["size_bytes", "outcome", "error"]
    added = (
        stored.join(several, same, "left_semi")
        .groupBy("word", "path", *file_columns)
        .agg(F.sum("frequency").alias("frequency"), F.sum("token_count").alias("token_count"))
    )
    return stored.join(several, same, "left_anti").unionByName(added)
