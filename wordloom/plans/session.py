"""A session that holds one index at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import query_argument, query_words
from wordloom.operators import search as ops
from wordloom.operators.blocks import search_best, write_blocks
from wordloom.operators.counted import count_pieces, counted_apart, counted_ledger, ledger_of_pieces
from wordloom.operators.postings import ledger, posting_rows, postings_of_word
from wordloom.operators.ranges import SAMPLED_PIECE, sampled_bounds
from wordloom.operators.sizing import text_parts_and
from wordloom.operators.statistics import PRINT_COLUMNS, equivalence, ledger_summary, rendered_stats
from wordloom.operators.store import (
    stored_files,
    stored_ledger,
    stored_postings,
    stored_postings_of,
    withdraw,
    write_index,
)
from wordloom.schemas import INDEX_STATS, POSTINGS, STAT_COLUMNS
from wordloom.sources.filelog import append_log, create_log, log_rows, read_log
from wordloom.sources.pieces import PIECE_BYTES
from wordloom.sources.stores import corpus_from_uri
from wordloom.sources.tables import corpus_from_table
from wordloom.sources.trees import corpus_from_tree
from wordloom.sources.workspace import claim, discard, entries_in, entry, exists, folder_of, new_location

_NO_STATS = dict.fromkeys(STAT_COLUMNS, 0)


class IndexSession:
    """Build an index, search it, look at its statistics.

    A build writes its tables first and replaces the current index only when it
    is complete, its log rows included. A build that fails leaves the index and
    the statistics as they were. A corpus in which a path occurs twice is
    refused. A file that cannot be read to its end is a failed file and leaves
    nothing in the index. The tables of replaced indexes stay for results that
    still read them; ``clear`` deletes them.
    """

    def __init__(
        self, spark: SparkSession, workspace: str | None = None, log: str | None = None
    ):
        self._spark = spark
        self._workspace = workspace
        self._log = log
        self._location: str | None = None
        self._replaced: list[str] = []
        self._stats = dict(_NO_STATS)
        self._runs: list[tuple] = []
        self._prints: list[tuple] = []
        self._generations: dict[str, int] = {}
        self._published: set[str] = set()
        if log is not None:
            create_log(spark, log)

    def index_tree(
        self,
        root: str,
        max_bytes: int | None = None,
        log: bool = True,
        run_id: str | None = None,
    ) -> DataFrame:
        """Index the files below ``root`` and return the statistics.

        With ``max_bytes``, larger files are skipped; by default none is.
        """
        scan = new_location(self._spark, "scan", self._workspace)
        try:
            corpus = corpus_from_tree(self._spark, root, max_bytes, scan)
            return self.index_corpus(corpus, log, run_id)
        finally:
            discard(self._spark, scan)

    def index_store(
        self,
        root: str,
        max_bytes: int | None = None,
        log: bool = True,
        run_id: str | None = None,
    ) -> DataFrame:
        """Index the files below a path or URI of any storage; nothing has to be mounted."""
        planned = new_location(self._spark, "plan", self._workspace)
        try:
            corpus = corpus_from_uri(self._spark, root, max_bytes, planned)
            return self.index_corpus(corpus, log, run_id)
        finally:
            discard(self._spark, planned)

    def index_table(
        self,
        documents: DataFrame,
        path: str = "path",
        text: str = "text",
        max_bytes: int | None = None,
        log: bool = True,
        run_id: str | None = None,
        partitions: int | None = None,
    ) -> DataFrame:
        """Index a table of documents and return the statistics.

        ``partitions`` deals the documents anew before their texts are read; use
        it for a table that has fewer splits than the cluster has cores. Texts of
        more than a part for each core are dealt by path in parts of bounded size.
        """
        if partitions is not None:
            documents = documents.repartition(partitions)
        corpus = corpus_from_table(documents, path, text, max_bytes, piece_bytes=PIECE_BYTES)
        special = counted_apart(path, F.octet_length(F.col(text)))
        parts, apart = text_parts_and(documents, special, text)
        if parts <= self._spark.sparkContext.defaultParallelism:
            return self._build(ledger(corpus), log, run_id)
        pieces = corpus_from_table(documents, path, text, max_bytes, piece_bytes=SAMPLED_PIECE)
        bounds = sampled_bounds(pieces, parts)
        entries = counted_ledger(corpus.repartition(parts, "path"), bounds, apart)
        return self._build(entries, log, run_id, bounds)

    def index_corpus(self, corpus: DataFrame, log: bool = True, run_id: str | None = None) -> DataFrame:
        """Index a corpus, each row of which is read and counted once.

        What is counted is stored first, so that ranges are cut from stored rows.
        """
        counted = new_location(self._spark, "counted", self._workspace)
        try:
            count_pieces(corpus, counted)
            return self._build(ledger_of_pieces(self._spark, counted), log, run_id)
        finally:
            discard(self._spark, counted)

    def _build(self, entries: DataFrame, log: bool, run_id: str | None, bounds: Sequence[str] = ()) -> DataFrame:
        location = new_location(self._spark, "index", self._workspace)
        try:
            write_index(entries, location, bounds)
            withdraw(self._spark, location)
            stored = stored_ledger(self._spark, location)
            counts = ledger_summary(stored).first()
            if log and self._log is not None:
                append_log(log_rows(stored_files(self._spark, location)), self._log)
        except Exception:
            discard(self._spark, location)
            raise
        replaced, self._location = self._location, location
        self._stats = {name: counts[name] for name in STAT_COLUMNS}
        name = run_id or f"run-{len(self._runs) + 1}"
        self._runs.append((name, *self._stats.values()))
        self._prints.append((name, tuple(counts[column] for column in PRINT_COLUMNS)))
        if replaced is not None:
            self._replaced.append(replaced)
        return self.stats()

    def publish(self, name: str = "index") -> int:
        """Make the current index the next generation of a named index; returns its number.

        It follows the generation this session opened or published last. If
        another session published one since, nothing changes and this is refused;
        the other generation can be opened, and this one stays searchable here.
        """
        self._require_index()
        number = self._generations.get(name, 0) + 1
        content = {
            "location": self._location,
            "stats": self._stats,
            "prints": list(self._prints[-1][1]),
        }
        if not claim(self._spark, self._generations_at(name), number, content):
            raise RuntimeError(f"generation {number} of {name} was published by another session")
        self._generations[name] = number
        self._published.add(self._location)
        return number

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        name: str = "index",
        workspace: str | None = None,
        log: str | None = None,
        generation: int | None = None,
    ) -> IndexSession:
        """A session over a published index, by default its last generation."""
        session = cls(spark, workspace, log)
        folder = session._generations_at(name)
        numbers = [one for one in entries_in(spark, folder) if generation in (None, one)]
        for number in reversed(numbers):
            content = entry(spark, folder, number)
            if content is not None:
                session._location = content["location"]
                session._stats = {column: content["stats"][column] for column in STAT_COLUMNS}
                run = f"generation-{number}"
                session._runs.append((run, *session._stats.values()))
                session._prints.append((run, tuple(content["prints"])))
                session._generations[name] = number
                session._published.add(session._location)
                return session
        raise ValueError(f"no such generation of {name}")

    def _generations_at(self, name: str) -> str:
        return f"{folder_of(self._spark, self._workspace)}/wordloom-generations/{name}"

    def snapshot(self) -> DataFrame:
        """The whole index as (word, path, frequency); empty before any build."""
        if self._location is None:
            return self._spark.createDataFrame([], POSTINGS)
        return posting_rows(stored_ledger(self._spark, self._location))

    def files(self) -> DataFrame:
        """The file rows of the current index, failed and skipped ones included."""
        self._require_index()
        return stored_files(self._spark, self._location)

    def compact(self) -> None:
        """Store the current index once more, in blocks, for searches with a limit."""
        self._require_index()
        write_blocks(self.snapshot(), self.files(), self._blocks_at())

    def _blocks_at(self) -> str:
        return f"{self._location}/_blocks"

    def postings(self, word: str) -> DataFrame:
        if self._location is None:
            return self.snapshot()
        return postings_of_word(stored_postings(self._spark, self._location, [word]), word)

    def search(self, query: str, limit: int | None = None) -> DataFrame:
        """Matching files, best first. A query without tokens matches nothing."""
        self._require_index()
        if not query_argument(query):
            raise ValueError("the query is empty")
        if limit is not None and exists(self._spark, f"{self._blocks_at()}/blocks/_SUCCESS"):
            return search_best(self._spark, self._blocks_at(), query, limit).results
        found = stored_postings(self._spark, self._location, query_words(query))
        return ops.search(found, query, limit)

    def search_batch(
        self, queries: DataFrame, id_column: str, text_column: str, limit: int | None = None
    ) -> DataFrame:
        """Matches of every query in a table, or its ``limit`` best with their rank."""
        self._require_index()
        terms = ops.query_terms(queries, id_column, text_column)
        found = stored_postings_of(self._spark, self._location, terms)
        found = ops.regrouped(found, terms)
        if limit is None:
            return ops.all_matches(found, terms)
        return ops.search_batch(found, terms, limit)

    def stats(self) -> DataFrame:
        """Statistics of the last complete build; zeros before any."""
        return self._spark.createDataFrame([tuple(self._stats.values())], INDEX_STATS)

    def stats_lines(self) -> DataFrame:
        return rendered_stats(self.stats())

    def runs(self) -> DataFrame:
        """Statistics of every build of this session, by ``run_id``."""
        columns = ", ".join(f"{name} bigint" for name in STAT_COLUMNS)
        return self._spark.createDataFrame(self._runs, f"run_id string, {columns}")

    def compare(self) -> DataFrame:
        """Each build of this session against the first one."""
        if not self._runs:
            raise RuntimeError("nothing was indexed yet")
        return equivalence(self.runs(), self._runs[0][0])

    def compare_postings(self) -> DataFrame:
        """Whether each build has the postings of the first one: (run_id, same_postings).

        Told by the fingerprints that builds keep, so no index is read again.
        """
        if not self._runs:
            raise RuntimeError("nothing was indexed yet")
        same = [(name, told == self._prints[0][1]) for name, told in self._prints]
        return self._spark.createDataFrame(same, "run_id string, same_postings boolean")

    def log(self) -> DataFrame:
        if self._log is None:
            raise RuntimeError("this session keeps no log")
        return read_log(self._spark, self._log)

    def clear(self) -> None:
        """Drop the index, its tables and its statistics. The log and published indexes stay."""
        gone = [*self._replaced, self._location]
        self._location, self._replaced = None, []
        self._stats = dict(_NO_STATS)
        for location in gone:
            if location is not None and location not in self._published:
                discard(self._spark, location)

    def _require_index(self) -> None:
        if self._location is None:
            raise RuntimeError("this session holds no index")
