"""Fixed schemas. Nothing in the engine infers a schema at run time."""

from __future__ import annotations

from pyspark.sql import types as T

#: One row per discovered file or document, with its text when it was read.
#: A large file has a row per piece of its text, numbered from 0.
CORPUS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("piece", T.IntegerType()),
    ]
)

#: The same row before anything is opened.
INVENTORY = T.StructType(CORPUS.fields[:4])

#: The inverted index, flat: unique on (word, path).
POSTINGS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)

#: What one build stores: a row per posting and, without a word, a row per file.
LEDGER = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("frequency", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("token_count", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

#: Files whose entries were taken back, with the reason.
WITHDRAWN = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

#: A row per file of a stored index: the words it spans and how its rows divide.
DIRECTORY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("first_word", T.StringType()),
        T.StructField("last_word", T.StringType()),
        T.StructField("words", T.LongType()),
        T.StructField("words_missing", T.LongType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("total_matches", T.LongType()),
        T.StructField("matched_terms", T.LongType()),
    ]
)

STAT_COLUMNS = (
    "discovered",
    "indexed",
    "failed",
    "skipped",
    "unique_words",
    "total_tokens",
)

INDEX_STATS = T.StructType([T.StructField(name, T.LongType()) for name in STAT_COLUMNS])

#: The append-only log of indexed files. No column may be null.
INDEXED_FILES = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("size_bytes", T.LongType(), False),
        T.StructField("token_count", T.LongType(), False),
        T.StructField("indexed_at", T.LongType(), False),
    ]
)
