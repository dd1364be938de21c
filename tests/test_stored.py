import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import brute_force, rows, table
from wordloom import IndexSession
from wordloom.operators import blocks, directory, search, store


def corpus(files=300, seed=1):
    """Few frequent words and many rare ones, with frequencies of all sizes."""
    rng = random.Random(seed)
    texts = {}
    for number in range(files):
        words = [f"w{rng.randrange(2000):04d}" for _ in range(60)] + ["the"] * rng.randrange(1, 6) + ["and"] * rng.randrange(3)
        if number % 97 == 5:
            words += ["the"] * 200 + ["rare"] * 30
        texts[f"d{number % 7}/f{number:04d}.txt"] = " ".join(words)
    return texts


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A session over an index of several files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    texts = corpus()
    session = IndexSession(spark, workspace=str(tmp_path_factory.mktemp("work")))
    session.index_table(table(spark, texts).repartition(4))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return session, texts


def opened(df):
    return {Path(name).name for name in df.inputFiles()}


def test_directory_tells_the_words_of_each_file(spark, built):
    session, texts = built
    found = brute_force(texts)
    told = spark.read.parquet(f"{session._location}/_directory").orderBy("first_word").collect()
    assert len(told) >= 4
    assert sum(r["words"] for r in told) == len(found) and sum(r["words_missing"] for r in told) == len(texts)
    spans = [(r["first_word"], r["last_word"]) for r in told if r["first_word"] is not None]
    assert all(one[1] <= other[0] for one, other in zip(spans, spans[1:]))


def test_lookups_open_only_the_files_that_can_hold_the_word(spark, built):
    session, texts = built
    found = brute_force(texts)
    every = opened(session.snapshot())
    for word in ("w0000", "rare", "w1999", "w1000"):
        lookup = session.postings(word)
        assert len(opened(lookup)) <= 2 < len(every)
        assert {(w, p): n for w, p, n in rows(lookup)} == {key: n for key, n in found.items() if key[0] == word}
    assert opened(session.postings("zzz")) == set() and rows(session.postings("zzz")) == []
    assert rows(session.postings("")) == []
    assert len(opened(session.files())) < len(every) and session.files().count() == len(texts)
    for query in ("rare w0007 zzz", "the", "w1999 w0000", "!!!"):
        assert rows(session.search(query)) == rows(search.search(session.snapshot(), query))
        assert len(opened(session.search(query))) <= 4


def test_a_batch_reads_a_part_of_the_index(spark, built):
    session, _ = built
    queries = spark.createDataFrame([(n, f"w00{n:02d} w00{n + 40:02d} unknown{n}") for n in range(40)] + [(99, None), (98, "!")], "id int, text string")
    terms = search.query_terms(queries, "id", "text")
    part = store.stored_postings_of(spark, session._location, terms)
    assert 0 < len(opened(part)) < len(opened(session.snapshot())) / 2
    key = lambda row: (row[0], row[1])
    assert sorted(rows(session.search_batch(queries, "id", "text")), key=key) == sorted(
        rows(search.all_matches(session.snapshot(), terms)), key=key
    )
    assert sorted(rows(session.search_batch(queries, "id", "text", limit=3))) == sorted(
        rows(search.search_batch(session.snapshot(), terms, 3))
    )
    nothing = queries.where("id = 98")
    assert rows(session.search_batch(nothing, "id", "text")) == []


def test_words_too_long_for_statistics(spark, tmp_path):
    texts = {"a.txt": "b " + "x" * 50_000, "b.txt": "x" * 9000 + " y", "c.txt": "one"}
    session = IndexSession(spark, workspace=str(tmp_path))
    session.index_table(table(spark, texts))
    for word, paths in {"x" * 50_000: ["a.txt"], "x" * 9000: ["b.txt"], "y": ["b.txt"], "b": ["a.txt"], "x": []}.items():
        assert [r["path"] for r in session.search(word).collect()] == paths
    assert session.files().count() == 3


def test_directories_of_many_files_are_made_by_executors(spark, built, monkeypatch):
    session, _ = built
    names = sorted(opened(session.snapshot()))
    (by_task,) = directory._teller(session._location)(iter([pa.RecordBatch.from_arrays([pa.array(names)], ["file"])]))
    assert [tuple(row.values()) for row in by_task.to_pylist()] == list(directory._told(session._location, names))


def test_empty_index_has_an_empty_directory(spark, tmp_path):
    session = IndexSession(spark, workspace=str(tmp_path))
    session.index_table(table(spark, {"a.bin": "x"}).where("false"))
    assert rows(session.search("x")) == [] and rows(session.files()) == []
    session.compact()
    assert rows(session.search("x", limit=3)) == []


# Blocks -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def blocked(spark, built, tmp_path_factory):
    session, texts = built
    location = str(tmp_path_factory.mktemp("blocks") / "of")
    blocks.write_blocks(session.snapshot(), session.files(), location, block_files=16)
    return session, texts, location


def test_numbers_are_dense_and_in_path_order(spark, blocked):
    _, texts, location = blocked
    numbered = blocks.numbered_files(spark, location).orderBy("number").collect()
    assert [r["number"] for r in numbered] == list(range(len(texts)))
    assert [r["path"] for r in numbered] == sorted(texts)


def test_blocks_hold_the_same_postings(spark, blocked):
    _, texts, location = blocked
    assert {(w, p): n for w, p, n in rows(blocks.block_postings(spark, location))} == brute_force(texts)
    for row in blocks.stored_blocks(spark, location).collect():
        assert row["places"] == sorted(row["places"]) and len(row["places"]) <= 16
        assert row["most"] == max(row["frequencies"]) and row["first"] % 16 == 0 and max(row["places"]) < 16


@pytest.mark.parametrize("query", ["the", "the rare", "rare", "and the w0001 w0002", "zzz", "!!!", "w0100 w0200 w0300", "and"])
@pytest.mark.parametrize("limit", [1, 3, 20, 1000])
def test_best_files_equal_the_whole_search(spark, blocked, query, limit, monkeypatch):
    session, _, location = blocked
    monkeypatch.setattr(blocks, "FIRST_BLOCKS", 2)
    found = blocks.search_best(spark, location, query, limit)
    assert rows(found.results) == rows(search.search(session.snapshot(), query, limit))


def test_blocks_that_cannot_hold_a_result_are_not_read(spark, blocked, monkeypatch):
    monkeypatch.setattr(blocks, "FIRST_BLOCKS", 2)
    session, texts, location = blocked
    found = blocks.search_best(spark, location, "the rare", 3)
    assert found.blocks >= 19 and found.blocks_read <= 4
    assert rows(found.results) == rows(search.search(session.snapshot(), "the rare", 3))
    assert found.results.first()["score"] > 200
    # Ties at the last place: every block that may hold one is read.
    flat = {f"f{n:03d}.txt": "same" for n in range(100)}
    other = IndexSession(spark)
    other.index_table(table(spark, flat))
    blocks.write_blocks(other.snapshot(), other.files(), f"{location}-flat", block_files=8)
    tied = blocks.search_best(spark, f"{location}-flat", "same", 10)
    assert [r["path"] for r in tied.results.collect()] == sorted(flat)[:10]


def test_blocks_take_fewer_bytes(spark, blocked):
    session, _, location = blocked

    def size(folder):
        return sum(one.stat().st_size for one in Path(folder).rglob("*.parquet") if "_directory" not in one.parts)

    session.snapshot().repartitionByRange(1, "word", "path").sortWithinPartitions("word", "path").write.option("compression", "zstd").parquet(f"{location}-flat-rows")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        blocks.write_blocks(session.snapshot(), session.files(), f"{location}-one")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert size(f"{location}-one/blocks") + size(f"{location}-one/files") < size(f"{location}-flat-rows")


def test_a_compacted_session_searches_its_blocks(spark, tmp_path):
    texts = corpus(80, 4)
    session = IndexSession(spark, workspace=str(tmp_path))
    session.index_table(table(spark, {**texts, "skipped.bin": "the", "empty.md": ""}))
    before = rows(session.search("the and", limit=7))
    session.compact()
    assert rows(session.search("the and", limit=7)) == before
    assert rows(session.search("the and"))[:7] == before
    session.index_table(table(spark, {"a.txt": "the"}))
    assert rows(session.search("the", limit=7)) == [("a.txt", 1, 1, 1)]
