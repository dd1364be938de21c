"""Word counts per file: the inverted index as flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import count_tokens, fold, raw_tokens
from wordloom.operators.classify import FAILED, INDEXED, outcome_of, readable
from wordloom.operators.sizing import fits_broadcast

#: Shards of the nested index. A posting list is cut into as many parts.
PATH_SHARDS = 256

#: Maps per file that its words are dealt to.
WORD_SHARDS = 16


def tokens(corpus: DataFrame) -> DataFrame:
    """One row (path, word) per token.

    The raw token is folded after the explode, where it is a generated-code
    expression, and not inside the array, where it would be interpreted.
    """
    return (
        readable(corpus)
        .select("path", F.explode(raw_tokens("text")).alias("token"))
        .select("path", fold("token").alias("word"))
    )


def positioned_tokens(corpus: DataFrame) -> DataFrame:
    """Token stream with the position of each token in its file."""
    return (
        readable(corpus)
        .select("path", F.posexplode(raw_tokens("text")).alias("position", "token"))
        .select("path", F.col("position").cast("bigint"), fold("token").alias("word"))
    )


def _count(stream: DataFrame) -> DataFrame:
    return stream.groupBy("word", "path").agg(F.count("*").alias("frequency"))


def postings(corpus: DataFrame) -> DataFrame:
    """The inverted index: (word, path, frequency).

    Tokens are counted on the map side first, so a file sends one row per
    distinct word. The shuffle key is (word, path): a word that occurs in
    every file is spread over all partitions.
    """
    return _count(tokens(corpus))


def postings_of(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the words in ``terms`` only.

    The filter runs on the token stream, before anything is counted or
    shuffled. With too many words to broadcast the filter comes after the
    counting, where a file holds each word once.
    """
    wanted = terms.select("word").distinct()
    if fits_broadcast(wanted):
        return _count(tokens(corpus).join(F.broadcast(wanted), "word", "left_semi"))
    return postings(corpus).join(wanted, "word", "left_semi")


def postings_of_word(index: DataFrame, word: str) -> DataFrame:
    """Posting list of one folded word; empty when it does not occur."""
    return index.where(F.col("word") == word)


def file_token_counts(corpus: DataFrame) -> DataFrame:
    """Tokens per indexed file, its pieces added up; empty files have 0."""
    counted = readable(corpus).select(
        "path", "size_bytes", count_tokens("text").alias("token_count")
    )
    return counted.groupBy("path", "size_bytes").agg(F.sum("token_count").alias("token_count"))


def file_word_counts(index: DataFrame, shards: int = WORD_SHARDS) -> DataFrame:
    """Word to frequency as maps: (path, shard, word_counts).

    The words of a file are dealt to ``shards`` maps by their checksum, so that
    no row has to hold all distinct words of a large file.
    """
    shard = F.pmod(F.crc32("word"), F.lit(shards)).cast("int")
    return index.groupBy("path", shard.alias("shard")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "frequency"))).alias("word_counts")
    )


def ledger(corpus: DataFrame) -> DataFrame:
    """Everything a build stores, from one pass over the text.

    Each piece of a file emits its tokens and one closing null. Grouping by
    (word, path) turns the tokens into postings and leaves the nulls as the row
    of the file, which alone carries its size, token count and outcome; its
    frequency is the number of rows that call themselves the first piece, so a
    path that occurs twice shows. Files without tokens, skipped files and failed
    files keep a row too.
    """
    outcome = outcome_of()
    found = F.when(outcome == INDEXED, raw_tokens("text"))
    closing = F.array(F.lit(None).cast("string"))
    stream = (
        corpus.select(
            "path",
            "size_bytes",
            "error",
            "piece",
            outcome.alias("outcome"),
            F.coalesce(found, F.array().cast("array<string>")).alias("found"),
        )
        .select(
            "path",
            "size_bytes",
            "error",
            "piece",
            "outcome",
            F.size("found").cast("bigint").alias("token_count"),
            F.explode(F.concat("found", closing)).alias("token"),
        )
    )
    is_file = F.col("token").isNull()
    file_columns = ["size_bytes", "outcome", "error"]
    return (
        stream.select(
            fold("token").alias("word"),
            "path",
            *[F.when(is_file, F.col(name)).alias(name) for name in (*file_columns, "token_count")],
            F.when(~is_file | (F.col("piece") == 0), 1).otherwise(0).alias("one"),
        )
        .groupBy("word", "path", *file_columns)
        .agg(F.sum("one").alias("frequency"), F.sum("token_count").alias("token_count"))
        .select("word", "path", "frequency", "size_bytes", "token_count", "outcome", "error")
    )


def repeated_paths(entries: DataFrame) -> DataFrame:
    """Paths that stand for more than one file in a ledger."""
    files = entries.where(F.col("word").isNull()).groupBy("path")
    return files.agg(F.sum("frequency").alias("files")).where(F.col("files") > 1)


def uncommitted(entries: DataFrame) -> DataFrame:
    """Files of which a part was read and a part could not: (path, size_bytes, error, files).

    A range of a file ends with its last piece or with a row that tells why it
    could not be read, and a file is committed if no range ended the second way.
    Paths that stand for more than one file are among the rows, with their number.
    """
    files = entries.where(F.col("word").isNull()).groupBy("path")
    told = files.agg(
        F.max("size_bytes").alias("size_bytes"),
        F.min("error").alias("error"),
        F.sum("frequency").alias("files"),
        F.count("*").alias("rows"),
        F.count_if(F.col("outcome") == FAILED).alias("failed"),
    )
    late = (F.col("failed") > 0) & (F.col("rows") > 1)
    return told.where((F.col("files") > 1) | late).select("path", "size_bytes", "error", "files")


def settled(entries: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """A ledger without what was read of uncommitted files, each of which failed instead.

    ``withdrawn`` holds (path, size_bytes, error). It is broadcast if it measures
    small enough.
    """
    gone = withdrawn.select("path")
    kept = entries.join(F.broadcast(gone) if fits_broadcast(gone) else gone, "path", "left_anti")
    failed = withdrawn.select(
        F.lit(None).cast("string").alias("word"),
        "path",
        F.lit(1).cast("bigint").alias("frequency"),
        "size_bytes",
        F.lit(0).cast("bigint").alias("token_count"),
        F.lit(FAILED).alias("outcome"),
        "error",
    )
    return kept.select(*failed.columns).unionByName(failed)


def posting_rows(entries: DataFrame) -> DataFrame:
    """The postings of a ledger."""
    return entries.where(F.col("word").isNotNull()).select("word", "path", "frequency")


def file_rows(entries: DataFrame) -> DataFrame:
    """The files of a ledger."""
    return entries.where(F.col("word").isNull()).select(
        "path", "size_bytes", "token_count", "outcome", "error"
    )


def nested_postings(index: DataFrame, shards: int = PATH_SHARDS) -> DataFrame:
    """Posting lists as arrays sorted by path: (word, shard, postings).

    A list holds the files of one shard only, so the list of a word that is in
    every file is cut into ``shards`` lists of bounded length. Which shard a
    file belongs to follows from its path alone.
    """
    shard = F.pmod(
        F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("bigint"),
        F.lit(shards).cast("bigint"),
    )
    return index.groupBy("word", shard.alias("shard")).agg(
        F.sort_array(F.collect_list(F.struct("path", "frequency"))).alias("postings")
    )
