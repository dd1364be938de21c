"""Corpora as files of token ids with access to every token.

Documents are ordered by id, and each task writes the shards of its range: a
directory of documents, then the ids as directly addressable codes. Reading
needs the shard only; where a document begins in the whole corpus follows from
prefix sums over one short row per shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm import dac
from wordloom.llm.scratch import kept, lookup, shared_folder
from wordloom.llm.tokens import encoder

#: Tokens after which a shard is closed. A longer document stays whole.
SHARD_TOKENS = 1 << 20
#: Chunk widths of the codes: whole bytes, which are written and read fastest.
WIDTHS = {2: [8, 8], 4: [8, 8, 8, 8]}
SUFFIX = ".dac"
MAGIC = b"WTOK"
_HEAD = struct.Struct("<4sQ")

_SHARD = "part int, shard int, documents bigint, tokens bigint"
_READ = "part int, shard int, place bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a folder given as path or URI."""
    return fs.FileSystem.from_uri(folder)


def write_whole(files: fs.FileSystem, path: str, data: bytes) -> None:
    """Write under another name first, so that no reader meets half a file."""
    early = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(early) as out:
        out.write(data)
    files.move(early, path)


def pack_shard(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A shard: number of documents, their ids, where each ends, then the codes."""
    ends = np.cumsum([len(one) for one in ids], dtype="<i8")
    return b"".join(
        (
            _HEAD.pack(MAGIC, len(doc_ids)),
            np.array([0 if one is None else one for one in doc_ids], "<i8").tobytes(),
            np.array([one is None for one in doc_ids], np.uint8).tobytes(),
            ends.astype("<i8").tobytes(),
            dac.encode(np.concatenate(ids), WIDTHS[ids[0].itemsize]) if ids else dac.encode(np.empty(0)),
        )
    )


class Shard:
    """One file: ``documents`` and ``codes``, which gives any token of it."""

    def __init__(self, data: bytes):
        magic, count = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("this is not a token shard")
        at = _HEAD.size
        ids = np.frombuffer(data, "<i8", count, at)
        missing = np.frombuffer(data, np.uint8, count, at + 8 * count)
        self.doc_ids = [None if no else one for one, no in zip(ids.tolist(), missing.tolist())]
        self.ends = np.frombuffer(data, "<i8", count, at + 9 * count)
        self.codes = dac.Codes(data, at + 17 * count)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def span(self, place: int) -> tuple[int, int]:
        return int(self.ends[place - 1]) if place else 0, int(self.ends[place])

    def tokens(self, place: int) -> np.ndarray:
        """All ids of the document at ``place``."""
        return self.codes.run(*self.span(place))


def _shard_writer(folder: str, vocabulary: str, end_id: int | None, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, path = store(folder)
        encode = encoder(vocabulary)
        ending = np.array([] if end_id is None else [end_id], encode.dtype).tobytes()
        rows, doc_ids, ids, tokens = [], [], [], 0

        def close() -> None:
            nonlocal doc_ids, ids, tokens
            shard = len(rows)
            write_whole(files, f"{path}/{part:08d}-{shard:08d}{SUFFIX}", pack_shard(doc_ids, ids))
            rows.append((part, shard, len(doc_ids), tokens))
            doc_ids, ids, tokens = [], [], 0

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                found = encode.encode(piece.column(1).to_pylist())
                for doc_id, packed in zip(piece.column(0).to_pylist(), found):
                    one = np.frombuffer(packed + ending, encode.dtype)
                    doc_ids.append(doc_id)
                    ids.append(one)
                    tokens += len(one)
                    if tokens >= shard_tokens:
                        close()
        if doc_ids:
            close()
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "shard", "documents", "tokens"])

    return write


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int | None = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode whole texts and write them in ascending id order; returns the shards.

    A null text counts as empty and still gets its ``end_id``. Rows without an
    id come first; rows that share one are ordered by text. An empty table
    writes no shard. The result, (part, shard, documents, tokens), is kept, so
    nothing is encoded again when it is used.
    """
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    ordered = (
        docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return kept(ordered.mapInArrow(_shard_writer(folder, vocabulary, end_id, shard_tokens), _SHARD))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = Shard(data.as_buffer().to_pybytes())
            part, number = (int(one) for one in name.split("-"))
            starts, lengths, sums = [], [], []
            for place in range(len(shard)):
                start, end = shard.span(place)
                starts.append(start)
                lengths.append(end - start)
                sums.append(zlib.crc32(shard.codes.run(start, end).astype("<u4", copy=False)))
            count = len(shard)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * count, pa.int32()),
                    pa.array([number] * count, pa.int32()),
                    pa.array(range(count), pa.int64()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["part", "shard", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )


def shard_starts(shards: DataFrame) -> DataFrame:
    """Tokens before each shard: sums within a part, on top of sums over the parts."""
    inside = Window.partitionBy("part").orderBy("shard")
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("tokens")).select("part", before.alias("part_start"))
    running = F.sum("tokens").over(inside) - F.col("tokens")
    return shards.select("part", "shard", running.alias("inside")).join(parts, "part").select(
        "part", "shard", (F.col("part_start") + F.col("inside")).alias("shard_start")
    )


def read_tokens(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Every document of the files: (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is taken
    over its ids as little-endian 32-bit numbers.
    """
    content = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(folder)
        .select(F.regexp_extract("path", r"([0-9]+-[0-9]+)\.dac$", 1).alias("name"), "content")
    )
    starts = lookup(kept(shard_starts(shards)))
    return (
        content.mapInArrow(_read_shards, _READ)
        .join(starts, ["part", "shard"])
        .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_file_rows(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the files of a corpus to the shared folder and read them back."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, vocabulary, end_id))
