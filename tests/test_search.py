import random

import pytest
from pyspark.sql import functions as F

from conftest import brute_force, rows, table
from plans import shuffle_rows
from wordloom.functions.text import query_words
from wordloom.operators import search
from wordloom.operators.postings import postings
from wordloom.plans import catalog
from wordloom.sources.tables import corpus_from_table


def expected_results(counts, query):
    found = {}
    for word in query_words(query):
        for (w, path), n in counts.items():
            if w == word:
                score, terms = found.get(path, (0, 0))
                found[path] = score + n, terms + 1
    return sorted(
        [(p, s, s, m) for p, (s, m) in found.items()], key=lambda r: (-r[1], r[0].encode())
    )


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    words = ["the", "a", "Cat", "dog", "x1", "é", "fox", "THE", "the"]
    return {
        f"r{n % 3}{'-b' if n % 2 else ''}/f{n}.txt": " ".join(random.choices(words, k=n % 23))
        for n in range(80)
    }


@pytest.fixture(scope="module")
def corpus(spark, texts):
    return corpus_from_table(table(spark, texts)).cache()


@pytest.mark.parametrize(
    "query", ["the", "the THE The", "cat dog", "fox, the; x1 zzz", "!!!", "zzz", "Cat-dog é"]
)
def test_search_in_index_and_text(corpus, texts, query):
    expected = expected_results(brute_force(texts), query)
    assert rows(search.search(postings(corpus), query)) == expected
    assert rows(search.search_text(corpus, query)) == expected
    assert rows(search.search(postings(corpus), query, limit=5)) == expected[:5]
    assert rows(search.search_text(corpus, query, limit=5)) == expected[:5]
    assert rows(search.search_text(corpus, query, in_pieces=True)) == expected


def test_long_queries(corpus, texts):
    query = "the cat fox " + " ".join(f"absent{n}" for n in range(1500))
    expected = expected_results(brute_force(texts), "the cat fox")
    assert rows(search.search(postings(corpus), query)) == expected


QUERIES = [(1, "the cat"), (2, "the the"), (3, "dog x1 a"), (4, "zzz"), (5, "!!")]


@pytest.mark.parametrize("max_broadcast_bytes", [search.BROADCAST_BYTES, 0])
def test_batch_search(spark, corpus, texts, max_broadcast_bytes):
    queries = spark.createDataFrame(QUERIES, "q int, body string")
    terms = search.query_terms(queries, "q", "body")
    found = search.all_matches(postings(corpus), terms, max_broadcast_bytes)
    counts = brute_force(texts)
    expected = {(q, *r) for q, body in QUERIES for r in expected_results(counts, body)}
    assert set(rows(found)) == expected
    for k in (3, 1500):
        top = search.search_batch(postings(corpus), terms, k, max_broadcast_bytes)
        assert set(rows(top)) == {
            (q, *r, n + 1)
            for q, body in QUERIES
            for n, r in enumerate(expected_results(counts, body)[:k])
        }


def test_top_beyond_the_window_limit(spark, monkeypatch):
    """A query with far more matches than ``k``, and ``k`` above the threshold."""
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        results = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("query_id"),
            F.format_string("f%05d", "id").alias("path"),
            (F.col("id") % 7).alias("score"),
        )
        best = {}
        for row in results.collect():
            best.setdefault(row["query_id"], []).append((-row["score"], row["path"]))
        expected = {
            (q, path, -score, n + 1)
            for q, found in best.items()
            for n, (score, path) in enumerate(sorted(found)[:20])
        }
        assert set(rows(search.top_per_query(results, 20))) == expected
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_the_batch_query_reports_every_match(spark, tmp_path):
    """More files than the 100 of each query that it once ended with."""
    texts = {n: " ".join(["the", "cat"] * (n % 9) + ["dog"] * (n % 2)) for n in range(260)}
    documents = [(n, text, f"src{n % 2}") for n, text in texts.items()]
    queries = [(1, "The cat"), (2, "dog?"), (3, "zzz"), (4, "the dog")]
    spark.createDataFrame(documents, "doc_id bigint, text string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(queries, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    paths = {row["doc_id"]: row["path"] for row in catalog.read_paths(spark, tmp_path).collect()}
    counts = brute_force({paths[n]: text for n, text in texts.items()})
    found = rows(catalog.search_batch(spark, str(tmp_path)))
    expected = {
        (q, *r, n + 1) for q, body in queries for n, r in enumerate(expected_results(counts, body))
    }
    assert set(found) == expected
    assert len(found) == len(expected) > 3 * 100


def many_matches(spark):
    """Queries with 2,000, 900, 90 and 10 matches, of few scores; one has no name and one path is missing."""
    sizes = {1: 2000, None: 900, 3: 90, 4: 10}
    made = [
        (q, None if n == 5 else f"f{n * 7919 % size:05d}", 1 + (n * n) % 4 * (n % 3 == 0), q == 1)
        for q, size in sizes.items()
        for n in range(size)
    ]
    return spark.createDataFrame(made, "query_id int, path string, score bigint, first boolean")


@pytest.mark.parametrize("max_broadcast_bytes", [search.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("ranked_rows", [search.RANKED_ROWS, 100, 20])
def test_all_ranks_are_exact_however_matches_are_cut(spark, monkeypatch, ranked_rows, max_broadcast_bytes):
    monkeypatch.setattr(search, "RANKED_ROWS", ranked_rows)
    monkeypatch.setattr(search, "SAMPLED_ROWS", 10)
    results = many_matches(spark)
    by_query = {}
    for row in rows(results):
        by_query.setdefault(row[0], []).append(row)
    expected = [
        (*row, n + 1)
        for found in by_query.values()
        for n, row in enumerate(sorted(found, key=lambda r: (-r[2], r[1] or "")))
    ]
    ranked = search.ranked_per_query(results, max_broadcast_bytes)
    assert ranked.columns == [*results.columns, "rank"]
    assert sorted(rows(ranked), key=str) == sorted(expected, key=str)
    assert rows(search.ranked_per_query(results.where("false"), max_broadcast_bytes)) == []


def test_matches_of_a_query_are_cut_into_pieces(spark, monkeypatch):
    """No piece has to hold all matches of a query, also where nearly all score the same."""
    monkeypatch.setattr(search, "RANKED_ROWS", 100)
    monkeypatch.setattr(search, "SAMPLED_ROWS", 10)
    results = many_matches(spark)
    bounds = search._piece_bounds(results)
    most = max(len(row["bounds"]) for row in bounds.collect())
    pieces = search._in_pieces(results, bounds, most).groupBy("query_id", "piece").count()
    sizes = {(q, piece): n for q, piece, n in rows(pieces)}
    assert len([q for q, _ in sizes if q == 1]) > 10
    assert max(sizes.values()) < 400


def test_query_terms(spark):
    queries = spark.createDataFrame([(1, "the THE cat"), (2, "?"), (3, "Cat")], "q int, body string")
    found = rows(search.query_terms(queries, "q", "body"))
    assert sorted(found) == [(1, "cat"), (1, "the"), (3, "cat")]


def test_rendered_results(corpus):
    results = search.search(postings(corpus), "the cat", limit=2)
    expected = [f"{p} | score={s} | matched_terms={m}" for p, s, _, m in rows(results)]
    assert [r[0] for r in rows(search.rendered_results(results))] == expected


def test_invariants(corpus, texts):
    for row in search.search(postings(corpus), "the cat dog a").collect():
        assert row["score"] == row["total_matches"]
        assert 1 <= row["matched_terms"] <= 4


def test_a_task_leaves_out_what_is_not_among_its_best(spark):
    """What is shuffled for the ranking grows with tasks and queries, not with matches."""
    results = spark.range(0, 60_000, 1, 2).select(
        (F.col("id") % 3).alias("query_id"),
        F.format_string("f%05d", "id").alias("path"),
        (F.col("id") % 7).alias("score"),
        (F.col("id") % 7).alias("total_matches"),
        F.lit(1).cast("bigint").alias("matched_terms"),
    )
    top = search.top_per_query(results, 5)
    best = {(q, n): [] for q in range(3) for n in range(1, 6)}
    assert {(r["query_id"], r["rank"]) for r in top.collect()} == set(best)
    plan = top._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    shuffled = [int(n) for n in shuffle_rows(plan)]
    assert max(shuffled) <= 2 * 3 * 5
