"""Keyword search: OR of distinct terms, scored by summed frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import distinct_terms, query_words, tokenize
from wordloom.operators.classify import readable
from wordloom.operators.sizing import BROADCAST_BYTES, GROUPED_ROWS, fits_broadcast, tasks_for
from wordloom.sources.workspace import new_location

#: Pieces a posting list is cut into when query terms are joined by shuffle, and
#: the matches of a query before they are ranked. Adaptive execution splits a
#: piece further if it is still far above the others.
SALTS = 64

#: Matches of a query that are ranked together, and how many of them are sampled to
#: tell where they are cut, about.
RANKED_ROWS, SAMPLED_ROWS = 50_000, 64


def _add_up(matches: DataFrame, *keys: str) -> DataFrame:
    return matches.groupBy(*keys).agg(
        F.sum("frequency").alias("score"),
        F.sum("frequency").alias("total_matches"),
        F.count("*").alias("matched_terms"),
    )


def ranked(results: DataFrame, limit: int | None = None) -> DataFrame:
    """Best score first, ties by path. All rows unless a limit is asked for."""
    ordered = results.orderBy(F.desc("score"), F.asc("path"))
    return ordered if limit is None else ordered.limit(limit)


def any_of(values: list, column: str = "word") -> Column:
    """The column is one of these, as a balanced tree of equalities.

    A reader skips pages and row groups per equality. A long IN list reaches it
    as one range from the least to the greatest value, which skips next to nothing.
    """
    if not values:
        return F.lit(False)
    if len(values) == 1:
        return F.col(column) == values[0]
    half = len(values) // 2
    return any_of(values[:half], column) | any_of(values[half:], column)


def search(index: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """Files holding any term of ``query``, best first.

    The terms become a filter, which reaches the Parquet scan of a stored index
    and goes below the counting of one that is computed on the fly.
    """
    words = sorted(query_words(query))
    matches = index.where(any_of(words))
    if len(words) == 1:
        # (word, path) is unique, so there is nothing to add up.
        found = matches.select(
            "path",
            F.col("frequency").alias("score"),
            F.col("frequency").alias("total_matches"),
            F.lit(1).cast("bigint").alias("matched_terms"),
        )
    else:
        found = _add_up(matches, "path")
    return ranked(found, limit)


def search_text(
    corpus: DataFrame, query: str, limit: int | None = None, in_pieces: bool = False
) -> DataFrame:
    """The same search straight from the text, for a corpus without an index.

    A row is scored inside itself and nothing is shuffled but the rows that
    match. Say ``in_pieces`` for a corpus that may hold a file in more than one
    row, as all corpora of files do: the rows of a file are then added up. The
    one-element array keeps the optimizer from evaluating the tokens a second
    time for the filter on empty matches.
    """
    words = query_words(query)
    found = F.filter(tokenize("text"), lambda word: word.isin(words))
    matches = readable(corpus).select(
        "path",
        F.explode(F.filter(F.array(found), lambda kept: F.size(kept) > 0)).alias("found"),
    )
    if in_pieces:
        # Whether a file holds a term is found out term by term, so the pieces of
        # a file are a few numbers and are never gathered into a list.
        held = [F.max(F.array_contains("found", word).cast("bigint")) for word in words]
        scored = matches.groupBy("path").agg(
            F.sum(F.size("found").cast("bigint")).alias("score"),
            sum(held, F.lit(0).cast("bigint")).alias("matched_terms"),
        )
    else:
        scored = matches.select(
            "path",
            F.size("found").cast("bigint").alias("score"),
            F.size(F.array_distinct("found")).cast("bigint").alias("matched_terms"),
        )
    if limit is None and not in_pieces:
        # A full sort samples its input first. Without this narrow shuffle the
        # sampling would read and tokenize the whole corpus once more.
        scored = scored.repartition("path")
    results = scored.select(
        "path", "score", F.col("score").alias("total_matches"), "matched_terms"
    )
    return ranked(results, limit)


def query_terms(queries: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row (query_id, word) per distinct term of each query."""
    return queries.select(
        F.col(id_column).alias("query_id"),
        F.explode(distinct_terms(text_column)).alias("word"),
    )


def match_terms(
    index: DataFrame, terms: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Postings of every query term: (query_id, word, path, frequency).

    The terms are broadcast when they measure small enough. Otherwise both
    sides are shuffled, with each posting list cut into SALTS pieces by path so
    that no task gets the whole list of a frequent word.
    """
    if fits_broadcast(terms, max_broadcast_bytes):
        return index.join(F.broadcast(terms), "word")
    pieces = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    salted_terms = terms.withColumn("salt", F.explode(pieces))
    salt = F.pmod(F.xxhash64("path"), F.lit(SALTS).cast("bigint"))
    return (
        index.withColumn("salt", salt).join(salted_terms, ["word", "salt"]).drop("salt")
    )


def regrouped(index: DataFrame, terms: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The postings of the words in ``terms``, dealt by path if the terms can be broadcast.

    An index is clustered by word, so the matches of a file come from everywhere and
    each would be shuffled for every query that has its word. Dealt by path first,
    a posting is shuffled once and the matches of a file are added up where they are.
    """
    if not fits_broadcast(terms, max_broadcast_bytes):
        return index
    wanted = F.broadcast(terms.select("word").distinct())
    found = index.join(wanted, "word", "left_semi")
    return found.repartition(tasks_for(found, F.lit(1), GROUPED_ROWS), "path")


def search_batch(
    index: DataFrame,
    terms: DataFrame,
    limit: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Search with a whole table of queries at once. All files of each unless a limit is asked for.

    ``terms`` comes from ``query_terms``. Returns (query_id, path, score,
    total_matches, matched_terms, rank).
    """
    found = all_matches(index, terms, max_broadcast_bytes)
    return ranked_per_query(found, max_broadcast_bytes) if limit is None else top_per_query(found, limit)


def all_matches(
    index: DataFrame, terms: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every match of every query. The result may come close to queries times files."""
    return _add_up(match_terms(index, terms, max_broadcast_bytes), "query_id", "path")


def top_per_query(results: DataFrame, k: int) -> DataFrame:
    """The first ``k`` files of each query, with their rank.

    A query that matches a third of all files is ranked in pieces first, each of
    which is cut to ``k`` files, so the final ranking sees few of them. The rows
    of a task are in one piece, so that the task leaves out what is not among
    the best ``k`` of its own before anything is shuffled.
    """
    best_first = (F.desc("score"), F.asc("path"))
    salt = F.spark_partition_id() % SALTS
    piece = Window.partitionBy("query_id", "salt").orderBy(*best_first)
    whole = Window.partitionBy("query_id").orderBy(*best_first)
    return (
        results.withColumn("salt", salt)
        .withColumn("piece_rank", F.row_number().over(piece))
        .where(F.col("piece_rank") <= k)
        .drop("salt", "piece_rank")
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def ranked_per_query(
    results: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES, workspace: str | None = None
) -> DataFrame:
    """All files of each query, with their rank.

    The matches of a query are cut, best first, into pieces of about ``RANKED_ROWS``
    that are sorted apart, and the sizes of the pieces tell which rank each begins
    with. A sample tells where to cut, so it moves the cuts and no rank. The matches
    are stored first, so that they are computed once.
    """
    spark = results.sparkSession
    location = new_location(spark, "ranks", workspace)
    results.write.parquet(f"{location}/matches")
    stored = spark.read.schema(results.schema).parquet(f"{location}/matches")
    sampled = _piece_bounds(stored)
    sampled.write.parquet(f"{location}/bounds")
    bounds = spark.read.schema(sampled.schema).parquet(f"{location}/bounds")
    tasks = tasks_for(stored, F.lit(1), GROUPED_ROWS)
    most = bounds.agg(F.max(F.size("bounds"))).first()[0]
    if most is None:
        # No query has enough matches to be cut.
        return _in_order(stored, tasks, "query_id")
    # A row per cut, and a piece begins at each.
    cuts = bounds.select("of", F.explode("bounds.path").alias("path"), F.lit(0).alias("below"))
    sent = F.broadcast if fits_broadcast(cuts, max_broadcast_bytes) else lambda df: df
    cut = _in_pieces(stored, sent(bounds), most)
    before = F.sum("rows").over(Window.partitionBy("query_id").orderBy("piece")) - F.col("rows")
    starts = (
        cut.groupBy("query_id", "piece")
        .agg(F.count("*").alias("rows"))
        .select(F.col("query_id").alias("of"), F.col("piece").alias("begun"), before.alias("before"))
        .where(F.col("begun") > 0)
    )
    same = F.col("query_id").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("begun"))
    rank = F.col("rank") + F.coalesce("before", F.lit(0).cast("bigint"))
    placed = _in_order(cut, tasks, "query_id", "piece").join(sent(starts), same, "left")
    return placed.select(*results.columns, rank.alias("rank"))


def _in_order(matches: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Matches with their rank among those of the same keys."""
    place = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("path"))
    return matches.repartition(tasks, *keys).withColumn("rank", F.row_number().over(place).cast("bigint"))


def _piece_bounds(results: DataFrame) -> DataFrame:
    """Where to cut the matches of queries that have many: (of, bounds), of being the query.

    Which matches are sampled follows from query and path.
    """
    drawn = F.pmod(F.xxhash64("query_id", "path"), F.lit(max(1, RANKED_ROWS // SAMPLED_ROWS)))
    key = F.struct((-F.col("score")).alias("below"), F.coalesce("path", F.lit("")).alias("path"))
    told = (
        results.where(drawn == 0)
        .groupBy(F.col("query_id").alias("of"))
        .agg(F.sort_array(F.collect_list(key)).alias("told"))
    )
    cuts = F.filter("told", lambda _, at: at % SAMPLED_ROWS == SAMPLED_ROWS - 1)
    return told.select("of", cuts.alias("bounds")).where(F.size("bounds") > 0)


def _in_pieces(results: DataFrame, bounds: DataFrame, most: int) -> DataFrame:
    """Rows with the number of their piece, which is how many bounds of the query do not come after a row.

    It is found by halving, a step per projection. ``most`` is the greatest number of bounds.
    """
    below, path, at = -F.col("score"), F.coalesce("path", F.lit("")), F.col("piece")
    cut = results.join(bounds, F.col("query_id").eqNullSafe(F.col("of")), "left")
    cut = cut.withColumn("piece", F.lit(0))
    step = 1 << (most.bit_length() - 1)
    while step:
        bound = F.get("bounds", at + (step - 1))
        same = (bound["below"] == below) & (bound["path"] <= path)
        cut = cut.withColumn("piece", F.when((bound["below"] < below) | same, at + step).otherwise(at))
        step //= 2
    return cut.drop("of", "bounds")


# Fixed value: the form of a result line.
RESULT_LINE = "%s | score=%d | matched_terms=%d"


def rendered_results(results: DataFrame) -> DataFrame:
    """One line per result, in the order of ``results``."""
    return results.select(
        F.format_string(
            RESULT_LINE, "path", "score", "matched_terms"
        ).alias("line")
    )
