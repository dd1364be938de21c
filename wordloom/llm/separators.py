"""Token counts of flat token files that have no index.

A flat file is nothing but ids, each document closed by an end-of-document id.
Files are cut into blocks that are searched for that id independently. What a
block cannot know, where its first document began and how many documents came
before, follows from a prefix scan over one short row per block.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, resident, shared_folder
from wordloom.llm.token_files import store

#: Fixed value: the pattern that cuts a text into words for these vocabularies.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: what the pattern takes for white space, as runs that are too long
# for its look-ahead, which goes back character by character.
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")
#: Bytes of a file that one row of work searches.
BLOCK_BYTES = 4 << 20
#: Tokens a writer holds before they go to the file.
_WRITE_TOKENS = 1 << 20
SUFFIX = ".ids"

_WRITTEN = "file string, place bigint, doc_id bigint"
_FILES = "file string, bytes bigint"
_FOUND = "file string, block bigint, seen bigint, at bigint, closed boolean"


def _rank_encoder(path: str):
    def load():
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        return tiktoken.Encoding("flat", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    return resident(("ranks", path), load)


def _text_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Ids of a whole text of any kind, none of its strings taken for a special token.

    The pattern makes one word of a run of white space, less its last character
    if something follows. Very long runs are cut out by this rule beforehand and
    given to the vocabulary as that one word.
    """
    encoding = _rank_encoder(vocabulary)

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        at = 0
        for run in _LONG_SPACE.finditer(text):
            ids += encoding.encode_ordinary(text[at : run.start()])
            at = run.end() if run.end() == len(text) else run.end() - 1
            ids += encoding._encode_single_piece(text[run.start() : at])
        return ids + encoding.encode_ordinary(text[at:])

    return encode


def _writer(folder: str, vocabulary: str, end_id: int, dtype: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        files, path = store(folder)
        name = f"{TaskContext.get().partitionId():08d}{SUFFIX}"
        early = f"{path}/{name}.{uuid.uuid4().hex}.tmp"
        encode = _text_encoder(vocabulary)
        place, held, waiting = 0, [], 0
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                out = files.open_output_stream(early)
            for text in batch.column(1):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                held.append(np.array(ids, dtype))
                waiting += len(ids)
                if waiting >= _WRITE_TOKENS:
                    out.write(np.concatenate(held).tobytes())
                    held, waiting = [], 0
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * count, pa.string()),
                    pa.array(range(place, place + count), pa.int64()),
                    batch.column(0),
                ],
                ["file", "place", "doc_id"],
            )
            place += count
        if out is not None:
            if held:
                out.write(np.concatenate(held).tobytes())
            out.close()
            files.move(early, f"{path}/{name}")

    return write


def write_flat(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    dtype: str = "<u2",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write whole texts as flat files, one per task, without moving a text.

    Returns which document stands where: (file, place, doc_id). A null text is
    an empty document, and a text of any length is written whole. Rows without
    an id and rows that repeat one are documents like any other; other columns
    are never looked at. ``end_id`` must be an id that the vocabulary never gives.
    """
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return kept(rows.mapInArrow(_writer(folder, vocabulary, end_id, dtype), _WRITTEN))


def _sizes(folder: str):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            infos = files.get_file_info([f"{path}/{name}" for name in names])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([info.size for info in infos], pa.int64())],
                ["file", "bytes"],
            )

    return look


def _searcher(folder: str, end_id: int, dtype: str):
    kind = np.dtype(dtype)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{path}/{row['file']}") as file:
                    data = file.read_at(row["length"], row["offset"])
                ids = np.frombuffer(data, kind)
                base = row["offset"] // kind.itemsize
                at = np.flatnonzero(ids == end_id) + base
                count = len(at)
                closed = [True] * count
                places = at.tolist()
                if row["last"]:
                    # The end of the file closes whatever no separator has closed.
                    places.append(base + len(ids))
                    closed.append(False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(places), pa.string()),
                        pa.array([row["block"]] * len(places), pa.int64()),
                        pa.array(range(len(places)), pa.int64()),
                        pa.array(places, pa.int64()),
                        pa.array(closed, pa.bool_()),
                    ],
                    ["file", "block", "seen", "at", "closed"],
                )

    return search


def count_tokens(
    spark: SparkSession,
    folder: str,
    names: DataFrame,
    end_id: int,
    dtype: str = "<u2",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents of flat files: (file, place, start, n_tokens, closed).

    ``names`` holds the file names in ``folder``. ``start`` counts the ids of
    the file before the document, ``n_tokens`` includes the closing id. Ids
    after the last closing id are a document with ``closed`` false; a file that
    ends with a closing id has none, and an empty file has no documents.
    """
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    sized = names.select("file").distinct().mapInArrow(_sizes(folder), _FILES).where("bytes > 0")
    last = F.floor((F.col("bytes") - 1) / block_bytes)
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block")
    blocks = sized.select("file", "bytes", every_block).select(
        "file",
        "block",
        (F.col("block") * block_bytes).alias("offset"),
        F.least(F.lit(block_bytes), F.col("bytes") - F.col("block") * block_bytes).cast("bigint").alias("length"),
        (F.col("block") == last).alias("last"),
    )
    found = kept(
        blocks.repartition("file", "block").mapInArrow(_searcher(folder, end_id, dtype), _FOUND)
    )
    # The prefix scan: documents closed before a block, and where the last of them ended.
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The end of a file takes the place of one more block, so that it gets its carry too.
    ends = found.where("not closed").select(
        "file",
        (F.col("block") + 1).alias("block"),
        F.lit(0).cast("bigint").alias("closings"),
        F.lit(None).cast("bigint").alias("last_at"),
    )
    carried = (
        found.where("closed")
        .groupBy("file", "block")
        .agg(F.count("*").alias("closings"), F.max("at").alias("last_at"))
        .unionByName(ends)
        .select(
            "file",
            "block",
            F.coalesce(F.sum("closings").over(order), F.lit(0)).alias("before"),
            F.coalesce(F.max("last_at").over(order) + 1, F.lit(0)).alias("from"),
        )
    )
    tail = F.when(F.col("closed"), F.col("block")).otherwise(F.col("block") + 1)
    inside = Window.partitionBy("file", "block").orderBy("at", F.desc("closed"))
    placed = (
        found.withColumn("previous", F.lag("at").over(inside))
        .withColumn("carry", tail)
        .join(carried.withColumnRenamed("block", "carry"), ["file", "carry"])
        .withColumn("start", F.coalesce(F.when(F.col("closed"), F.col("previous") + 1), F.col("from")))
    )
    place = F.when(F.col("closed"), F.col("before") + F.col("seen")).otherwise(F.col("before"))
    length = F.col("at") - F.col("start") + F.when(F.col("closed"), 1).otherwise(0)
    return placed.select("file", place.alias("place"), "start", length.alias("n_tokens"), "closed").where(
        F.col("closed") | (F.col("n_tokens") > 0)
    )


def flat_token_rows(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Token counts of a corpus, from its flat files: (doc_id, file, start, n_tokens)."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "flat")
    written = write_flat(docs, folder, vocabulary, end_id)
    counted = count_tokens(spark, folder, written.select("file"), end_id)
    return counted.join(written, ["file", "place"]).select("doc_id", "file", "start", "n_tokens")
