"""Each operator as a query over the given tables.

The corpus is the view ``files``: one file per row of ``documents``, whole and
all of them supported, in folders whose component order and string order differ.
The queries named scan_* see the same documents under names that mix upper case,
unsupported and missing suffixes, since choosing among these is what they do.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as fn
from wordloom.operators import blocks, classify, postings, search, statistics
from wordloom.operators.sizing import dealt_texts
from wordloom.plans.session import IndexSession
from wordloom.sources import stores, trees
from wordloom.sources.filelog import append_log, log_rows, read_log
from wordloom.sources.pieces import PIECE_BYTES
from wordloom.sources.tables import corpus_from_table
from wordloom.sources.workspace import new_location

#: Size rule of scan_size_cap and its like, low enough to leave out files of this data.
CAP = 7000

#: A query with a repeated term, upper case and a frequent word.
QUERY = "the DER the pag"
SINGLE = "the"
MULTI = "ing, and; THE und-les on"

#: More terms than a reader takes from an IN list.
MANY = "the of and to in that it is was for on are with und der die que los les des zzzz"

SUFFIXES = [".txt", ".MD", ".log", ".csv"]
MIXED_SUFFIXES = [*SUFFIXES, ".bin", ""]


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def file_path(suffixes: list[str] = SUFFIXES) -> Column:
    number = F.col("doc_id")
    folder = F.when(F.pmod(F.floor(number / 20), F.lit(2)) == 1, "-b").otherwise("")
    place = F.pmod(number, F.lit(len(suffixes))).cast("int")
    return F.concat(
        F.lit("corpus/"),
        "source",
        folder,
        F.format_string("/document-%06d", number),
        F.get(F.array(*[F.lit(s) for s in suffixes]), place),
    )


def named(spark: SparkSession, directory: str, suffixes: list[str] = SUFFIXES) -> DataFrame:
    return read(spark, directory, "documents").select(
        file_path(suffixes).alias("path"), "text", "source"
    )


def files(spark: SparkSession, directory: str) -> DataFrame:
    return corpus_from_table(named(spark, directory), keep=["source"])


def scanned(spark: SparkSession, directory: str) -> DataFrame:
    """The files of the scan queries, under the size rule."""
    mixed = named(spark, directory, MIXED_SUFFIXES)
    return corpus_from_table(mixed, max_bytes=CAP, keep=["source"])


def corpus(spark: SparkSession, directory: str) -> DataFrame:
    """The same texts in bounded pieces, dealt by path.

    Tokens are counted by (word, path) after this without another shuffle, and
    a text is smaller than the postings it gives.
    """
    documents = named(spark, directory)
    pieces = corpus_from_table(documents, keep=["source"], piece_bytes=PIECE_BYTES)
    return dealt_texts(pieces, documents)


def index(spark: SparkSession, directory: str) -> DataFrame:
    return postings.postings(corpus(spark, directory))


# Scans ---------------------------------------------------------------------


def scan_supported_ext(spark, directory):
    return named(spark, directory, MIXED_SUFFIXES).select("path").where(fn.is_supported("path"))


def scan_size_cap(spark, directory):
    small = scanned(spark, directory).where(F.col("size_bytes") <= CAP)
    return small.select("path", "size_bytes")


def scan_classify(spark, directory):
    return scanned(spark, directory).select("path", "size_bytes", "status")


def scan_status_counts(spark, directory):
    return classify.status_counts(scanned(spark, directory))


def scan_order(spark, directory):
    return classify.in_scan_order(named(spark, directory, MIXED_SUFFIXES))


def file_extension(spark, directory):
    paths = named(spark, directory, MIXED_SUFFIXES)
    return paths.select("path", fn.file_extension("path").alias("extension"))


# Tokens --------------------------------------------------------------------


def tokenize_rows(spark, directory):
    return postings.positioned_tokens(files(spark, directory))


def token_array_size(spark, directory):
    return files(spark, directory).select(
        "path", F.size(fn.tokenize("text")).cast("bigint").alias("token_count")
    )


def file_token_counts(spark, directory):
    return postings.file_token_counts(files(spark, directory)).select("path", "token_count")


def token_count_by_line(spark, directory):
    return files(spark, directory).select(
        "path", fn.count_tokens_by_line("text").alias("token_count")
    )


def page_tokens(spark, directory):
    """Tokens of raw web pages, which hold far more bytes that separate tokens."""
    return read(spark, directory, "pages").select(
        "page_id", fn.count_tokens("html").alias("token_count")
    )


# Index and statistics -------------------------------------------------------


def index_postings(spark, directory):
    return index(spark, directory)


def inverted_index(spark, directory):
    nested = postings.nested_postings(index(spark, directory))
    entry = F.transform(
        "postings", lambda p: F.concat(p["path"], F.lit(":"), p["frequency"].cast("string"))
    )
    return nested.select("word", "shard", F.array_join(entry, ",").alias("postings"))


def file_word_counts(spark, directory):
    """Per-file maps, looked into for their sizes, totals and one word."""
    counts = postings.file_word_counts(index(spark, directory))
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(F.map_values("word_counts"), zero, lambda total, n: total + n)
    the = F.coalesce(F.try_element_at("word_counts", F.lit("the")), zero)
    return counts.groupBy("path").agg(
        F.sum(F.size("word_counts").cast("bigint")).alias("distinct_words"),
        F.sum(total).alias("token_count"),
        F.sum(the).alias("the_count"),
    )


def index_stats(spark, directory):
    return statistics.index_stats(corpus(spark, directory))


def index_stats_by_source(spark, directory):
    return statistics.index_stats(corpus(spark, directory), by=["source"])


def stats_rendered(spark, directory):
    return statistics.rendered_stats(index_stats(spark, directory))


def with_failures(spark, directory):
    """The corpus with files that could not be read: every seventh document."""
    broken = F.when(F.pmod(F.col("doc_id"), F.lit(7)) == 3, "unreadable")
    docs = read(spark, directory, "documents").select(
        file_path().alias("path"), "text", "source", broken.alias("broken")
    )
    return corpus_from_table(docs, keep=["source", "broken"]).withColumn("error", F.col("broken"))


def stats_with_failures(spark, directory):
    broken = with_failures(spark, directory)
    return statistics.index_stats(dealt_texts(broken, broken), by=["source"])


def failed_files(spark, directory):
    return classify.failures(with_failures(spark, directory))


def _builds(base):
    """Statistics of three builds: counted directly, from the ledger, and line by line."""
    by_line = F.flatten(F.transform(F.split("text", "\n"), fn.raw_tokens))
    return {
        "direct": statistics.index_stats(base),
        "ledger": statistics.ledger_stats(postings.ledger(base)),
        "by_line": statistics.index_stats(base, words=by_line),
    }


def _compared(builds):
    runs = None
    for name, stats in builds.items():
        row = stats.select(F.lit(name).alias("run_id"), *stats.columns)
        runs = row if runs is None else runs.unionByName(row)
    return statistics.equivalence(runs, "direct")


def stats_equivalence(spark, directory):
    return _compared(_builds(corpus(spark, directory)))


def stats_differ(spark, directory):
    """The same comparison with a build that lost the documents of one source."""
    base = corpus(spark, directory)
    builds = _builds(base)
    builds["changed"] = statistics.index_stats(base.where(F.col("source") != "src1"))
    return _compared(builds)


def postings_equivalence(spark, directory):
    """Postings that differ between two ways to build them; there are none."""
    base = corpus(spark, directory)
    from_ledger = postings.posting_rows(postings.ledger(base))
    return statistics.differing_postings(postings.postings(base), from_ledger)


def postings_differ(spark, directory):
    """Postings that differ when one side lost a word and counts another once too often."""
    base = corpus(spark, directory)
    changed = postings.posting_rows(postings.ledger(base)).where(F.col("word") != "the")
    one_more = F.col("frequency") + F.when(F.col("word") == "und", 1).otherwise(0)
    return statistics.posting_differences(
        postings.postings(base), changed.withColumn("frequency", one_more)
    )


def file_log_rows(spark, directory):
    return postings.file_token_counts(files(spark, directory))


# Files of a tree or store ------------------------------------------------------


def _writer(location: str):
    """Write each text as a file of its path below a folder; tells which it wrote."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(location)
        made = set()
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = f"{folder}/{path}"
                parent = place.rpartition("/")[0]
                if parent not in made:
                    files.create_dir(parent, recursive=True)
                    made.add(parent)
                with files.open_output_stream(place) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    return write


def written(spark: SparkSession, directory: str, suffixes: list[str]) -> str:
    """The documents as files of a tree in the workspace; returns its root."""
    root = new_location(spark, "files")
    docs = named(spark, directory, suffixes).where(F.col("text").isNotNull()).select("path", "text")
    docs.mapInArrow(_writer(root), "path string").agg(F.count("*")).collect()
    return root


def _below(root: str, df: DataFrame) -> DataFrame:
    """The same rows with paths as they are below the root."""
    return df.withColumn("path", F.substring("path", len(root) + 2, 1 << 20))


def tree_inventory(spark, directory):
    """The tree that the documents were written to, classified without opening a file."""
    root = written(spark, directory, MIXED_SUFFIXES)
    return _below(root, trees.inventory(spark, _local(root), CAP)).select("path", "size_bytes", "status")


def tree_postings(spark, directory):
    root = _local(written(spark, directory, SUFFIXES))
    return _below(root, postings.postings(trees.corpus_from_tree(spark, root)))


def store_inventory(spark, directory):
    """The same through the interface of the storage, with a URI as root."""
    root = f"file://{_local(written(spark, directory, MIXED_SUFFIXES))}"
    return _below(root, stores.corpus_from_uri(spark, root, CAP)).select("path", "size_bytes", "status")


def store_postings(spark, directory):
    """Postings of files that are read in ranges and pieces far smaller than they are."""
    root = f"file://{_local(written(spark, directory, SUFFIXES))}"
    read = stores.corpus_from_uri(spark, root, piece_bytes=500, range_bytes=2000)
    return _below(root, postings.postings(read))


def store_lost_files(spark, directory):
    """A build during which every seventh file is lost after it was listed."""
    root = _local(written(spark, directory, SUFFIXES))
    read = stores.corpus_from_uri(spark, f"file://{root}")
    lost = read_paths(spark, directory).where(F.pmod(F.col("doc_id"), F.lit(7)) == 3)
    lost.select("path").mapInArrow(_remover(root), "path string").agg(F.count("*")).collect()
    session = IndexSession(spark)
    session.index_corpus(read)
    return session.stats()


def read_paths(spark: SparkSession, directory: str) -> DataFrame:
    return read(spark, directory, "documents").select("doc_id", file_path().alias("path"))


def _remover(root: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                os.unlink(f"{root}/{path}")
            yield batch

    return remove


def _local(root: str) -> str:
    """A location in a workspace that is mounted, as a plain path."""
    return fs.FileSystem.from_uri(root)[1]


def postings_in_pieces(spark, directory):
    """Postings of texts that are cut into pieces of a kilobyte."""
    cut = corpus_from_table(named(spark, directory), piece_bytes=1024)
    return postings.postings(cut)


# Query strings ---------------------------------------------------------------


def arguments(spark, directory):
    """Command arguments: texts wrapped in white space and quotes by doc_id."""
    number = F.pmod(F.col("doc_id"), F.lit(8)).cast("int")
    before = ["", "\t ", '"', " '", "'", '"" ', "\u000b\f", "\u00a0"]
    after = ["", " \r\n", '"', "'\t", '"', ' ""', "\n", "\u00a0"]

    def pick(values):
        return F.get(F.array(*[F.lit(value) for value in values]), number)

    return read(spark, directory, "documents").select(
        "doc_id", F.concat(pick(before), "text", pick(after)).alias("argument")
    )


def query_trim(spark, directory):
    return arguments(spark, directory).select(
        "doc_id", fn.trim_space("argument").alias("trimmed")
    )


def query_unquote(spark, directory):
    return arguments(spark, directory).select(
        "doc_id", fn.unquote("argument").alias("unquoted")
    )


def benchmark_terms(spark, directory):
    return search.query_terms(read(spark, directory, "benchmark"), "item_id", "text")


# Search ----------------------------------------------------------------------


def postings_lookup(spark, directory):
    return postings.postings_of_word(index(spark, directory), "the")


def postings_lookup_missing(spark, directory):
    return postings.postings_of_word(index(spark, directory), "zzzz")


def search_all(spark, directory):
    return search.search(index(spark, directory), QUERY)


def search_single_term(spark, directory):
    return search.search(index(spark, directory), SINGLE)


def search_multi_term(spark, directory):
    return search.search(index(spark, directory), MULTI)


def search_no_match(spark, directory):
    return search.search(index(spark, directory), "zzzz qqqqq")


def search_top20(spark, directory):
    return search.search(index(spark, directory), QUERY, limit=20)


def search_rendered(spark, directory):
    return search.rendered_results(search.search_text(files(spark, directory), QUERY))


def search_scan(spark, directory):
    return search.search_text(files(spark, directory), QUERY)


def search_scan_top20(spark, directory):
    return search.search_text(files(spark, directory), QUERY, limit=20)


def _batch(spark, directory, limit=None):
    """Every text of ``benchmark`` as a query, over all documents."""
    terms = benchmark_terms(spark, directory)
    found = postings.postings_of(corpus(spark, directory), terms)
    return search.search_batch(found, terms, limit)


def search_batch(spark, directory):
    return _batch(spark, directory)


def search_batch_top10(spark, directory):
    return _batch(spark, directory, 10)


# Session ---------------------------------------------------------------------


def _session(spark, directory):
    session = IndexSession(spark)
    session.index_table(named(spark, directory))
    return session


def session_search(spark, directory):
    return _session(spark, directory).search(QUERY)


def session_search_many_terms(spark, directory):
    return _session(spark, directory).search(MANY)


def session_lookup(spark, directory):
    """The postings of a word, from the index files that can hold it."""
    return _session(spark, directory).postings("the")


def session_batch_top10(spark, directory):
    """Every text of ``benchmark`` as a query against a stored index."""
    queries = read(spark, directory, "benchmark")
    return _session(spark, directory).search_batch(queries, "item_id", "text", limit=10)


def session_best20(spark, directory):
    """The best files by the blocks of a compacted index."""
    session = _session(spark, directory)
    session.compact()
    return session.search(QUERY, limit=20)


def block_postings(spark, directory):
    """The postings again from the blocks they were packed into."""
    session = _session(spark, directory)
    location = new_location(spark, "blocks")
    blocks.write_blocks(session.snapshot(), session.files(), location, block_files=256)
    return blocks.block_postings(spark, location)


def session_reopened(spark, directory):
    """A search by a session that opened an index another one published."""
    name = f"catalog-{uuid.uuid4().hex}"
    _session(spark, directory).publish(name)
    return IndexSession.open(spark, name).search(QUERY)


def session_stats(spark, directory):
    session = _session(spark, directory)
    stats = session.stats()
    session.clear()
    return stats


def session_log(spark, directory):
    """A build, its log written and read back, without the time."""
    location = new_location(spark, "log")
    session = _session(spark, directory)
    append_log(log_rows(session.files()), location)
    session.clear()
    return read_log(spark, location).drop("indexed_at")


def session_rebuild(spark, directory):
    """The word counts after a second build, which replaced the first."""
    session = _session(spark, directory)
    session.index_table(named(spark, directory).where(F.col("source") == "src1"))
    return session.snapshot().groupBy("word").agg(F.sum("frequency").alias("frequency"))


def session_clear(spark, directory):
    """Statistics before and after an index is dropped."""
    session = _session(spark, directory)
    before = session.stats().select(F.lit("before").alias("state"), "*")
    session.clear()
    return before.unionByName(session.stats().select(F.lit("after").alias("state"), "*"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_supported_ext": scan_supported_ext,
    "scan_size_cap": scan_size_cap,
    "scan_classify": scan_classify,
    "scan_status_counts": scan_status_counts,
    "scan_order": scan_order,
    "file_extension": file_extension,
    "tokenize_rows": tokenize_rows,
    "token_array_size": token_array_size,
    "file_token_counts": file_token_counts,
    "token_count_by_line": token_count_by_line,
    "page_tokens": page_tokens,
    "postings": index_postings,
    "inverted_index": inverted_index,
    "file_word_counts": file_word_counts,
    "index_stats": index_stats,
    "index_stats_by_source": index_stats_by_source,
    "stats_rendered": stats_rendered,
    "stats_with_failures": stats_with_failures,
    "failed_files": failed_files,
    "stats_equivalence": stats_equivalence,
    "stats_differ": stats_differ,
    "postings_equivalence": postings_equivalence,
    "postings_differ": postings_differ,
    "file_log_rows": file_log_rows,
    "tree_inventory": tree_inventory,
    "tree_postings": tree_postings,
    "store_inventory": store_inventory,
    "store_postings": store_postings,
    "store_lost_files": store_lost_files,
    "postings_in_pieces": postings_in_pieces,
    "query_trim": query_trim,
    "query_unquote": query_unquote,
    "query_terms": benchmark_terms,
    "postings_lookup": postings_lookup,
    "postings_lookup_missing": postings_lookup_missing,
    "search_all": search_all,
    "search_single_term": search_single_term,
    "search_multi_term": search_multi_term,
    "search_no_match": search_no_match,
    "search_top20": search_top20,
    "search_rendered": search_rendered,
    "search_scan": search_scan,
    "search_scan_top20": search_scan_top20,
    "search_batch": search_batch,
    "search_batch_top10": search_batch_top10,
    "session_search": session_search,
    "session_search_many_terms": session_search_many_terms,
    "session_lookup": session_lookup,
    "session_batch_top10": session_batch_top10,
    "session_best20": session_best20,
    "block_postings": block_postings,
    "session_reopened": session_reopened,
    "session_stats": session_stats,
    "session_log": session_log,
    "session_rebuild": session_rebuild,
    "session_clear": session_clear,
}
