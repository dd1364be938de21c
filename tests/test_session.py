from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import brute_force, rows, table
from plans import shuffle_rows
from wordloom import IndexSession
from wordloom.operators import counted, ranges, sizing
from wordloom.operators.postings import file_token_counts, ledger, postings
from wordloom.operators.search import search_text
from wordloom.operators.statistics import differing_postings, fingerprint, index_stats, posting_differences
from wordloom.plans import session as session_module
from wordloom.sources import filelog
from wordloom.sources.tables import corpus_from_table
from wordloom.sources.workspace import exists


def results(df, root):
    return [(r["path"].removeprefix(f"{root}/"), r["score"], r["matched_terms"]) for r in df.collect()]


def test_sample_files(spark, sample_tree, tmp_path):
    session = IndexSession(spark, log=str(tmp_path / "log"))
    stats = session.index_tree(str(sample_tree))
    assert rows(stats) == [(2, 2, 0, 0, 43, 49)]
    expected = {
        "concurrency thread": [("notes.txt", 1, 1)],
        "the": [("notes.txt", 2, 1), ("readme.md", 1, 1)],
        "the THE The": [("notes.txt", 2, 1), ("readme.md", 1, 1)],
        "the path files": [("readme.md", 3, 3), ("notes.txt", 2, 1)],
        "file": [("notes.txt", 1, 1)],
        "!!!": [],
        "absent": [],
    }
    for query, found in expected.items():
        assert results(session.search(query), sample_tree) == found
    logged = {(r["path"], r["size_bytes"], r["token_count"]) for r in session.log().collect()}
    assert logged == {
        (f"{sample_tree}/notes.txt", 140, 25), (f"{sample_tree}/readme.md", 130, 24),
    }
    assert rows(session.postings("nothing")) == []
    assert rows(session.postings("tie")) == [("tie", f"{sample_tree}/readme.md", 1)]
    assert dict(rows(session.stats_lines()))["Total tokens"] == 49


def test_rebuild_replaces_the_index_and_the_log_grows(spark, tmp_path):
    session = IndexSession(spark, log=str(tmp_path / "log"))
    session.index_table(table(spark, {"a.txt": "one two", "b.txt": ""}))
    first = session._location
    assert session.log().count() == 2
    session.index_table(table(spark, {"c.txt": "two three"}))
    assert {r["word"] for r in session.snapshot().collect()} == {"two", "three"}
    assert session.log().count() == 3
    session.index_table(table(spark, {"c.txt": "two three"}))
    assert session.log().count() == 4
    session.index_table(table(spark, {"c.txt": "two three"}), log=False)
    session.index_table(table(spark, {"c.bin": "two three"}))
    assert session.log().count() == 4
    assert exists(spark, first)
    assert rows(session.stats()) == [(1, 0, 0, 1, 0, 0)]
    assert [r["equivalent"] for r in session.compare().orderBy("run_id").collect()] == [
        True, False, False, False, False,
    ]


def test_guards_and_clear(spark, tmp_path):
    session = IndexSession(spark, log=str(tmp_path / "log"))
    assert rows(session.stats()) == [(0, 0, 0, 0, 0, 0)]
    assert session.snapshot().isEmpty()
    with pytest.raises(RuntimeError):
        session.search("x")
    with pytest.raises(RuntimeError):
        session.compare()
    session.index_table(table(spark, {"a.txt": "one"}))
    for empty in ("", " \t", '""', " '' "):
        with pytest.raises(ValueError):
            session.search(empty)
    earlier = session._location
    session.index_table(table(spark, {"b.txt": "two"}))
    location = session._location
    session.clear()
    assert not exists(spark, location) and not exists(spark, earlier)
    assert rows(session.stats()) == [(0, 0, 0, 0, 0, 0)]
    assert session.log().count() == 2
    with pytest.raises(RuntimeError):
        session.search("one")


def test_repeated_paths_are_refused(spark, tmp_path):
    session = IndexSession(spark, workspace=str(tmp_path / "work"))
    session.index_table(table(spark, {"a.txt": "one"}))
    twice = spark.createDataFrame(
        [("a.txt", "one"), ("b.txt", "x"), ("b.txt", "x"), ("c.txt", "y")], "path string, text string"
    )
    with pytest.raises(ValueError, match="b.txt"):
        session.index_table(twice)
    other = spark.createDataFrame([("c.txt", "one"), ("c.txt", "two x")], "path string, text string")
    with pytest.raises(ValueError, match="c.txt"):
        session.index_table(other)
    assert [r["path"] for r in session.search("one").collect()] == ["a.txt"]


def test_results_outlive_the_next_build(spark):
    session = IndexSession(spark)
    session.index_table(table(spark, {"a.txt": "one"}))
    found = session.search("one")
    session.index_table(table(spark, {"b.txt": "one"}))
    assert [r["path"] for r in found.collect()] == ["a.txt"]


def test_document_numbers_above_six_digits_stay_apart(spark, tmp_path):
    from wordloom.plans import catalog

    numbers = [5, 123456, 1234560, 1234561, 1234566, 98765432]
    docs = spark.createDataFrame(
        [(n, f"only{n}", "en", "s", 1) for n in numbers],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    log = catalog.session_log(spark, str(tmp_path)).collect()
    assert len({r["path"] for r in log}) == len(numbers)
    assert catalog.index_stats(spark, str(tmp_path)).first()["indexed"] == len(numbers)


@pytest.mark.parametrize("name", ["postings", "search_top20", "search_batch_top10", "index_stats"])
def test_plans_do_not_depend_on_the_size(spark, name):
    from wordloom.plans import catalog

    def shape(directory):
        df = catalog.QUERIES[name](spark, directory)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return [line.split("(")[0].strip(" :+-").split(" ")[0] for line in plan.splitlines()]

    assert shape("/root/testdata/sf0.001") == shape("/root/testdata/sf0.1")


def test_failed_build_leaves_everything_as_it_was(spark, tmp_path, monkeypatch):
    session = IndexSession(spark, workspace=str(tmp_path / "work"), log=str(tmp_path / "log"))
    session.index_table(table(spark, {"a.txt": "one two"}))
    before = rows(session.stats())
    with pytest.raises(ValueError):
        session.index_tree(str(tmp_path / "missing"))
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree" / "x.txt").write_text("four")

    def refuse(files):
        raise OSError("no space")

    monkeypatch.setattr(session_module, "log_rows", refuse)
    with pytest.raises(OSError):
        session.index_table(table(spark, {"b.txt": "three"}))
    with pytest.raises(OSError):
        session.index_tree(str(tmp_path / "tree"))
    assert rows(session.stats()) == before
    assert [r["path"] for r in session.search("one").collect()] == ["a.txt"]
    assert len([p for p in (tmp_path / "work").iterdir()]) == 1


def test_log_batches_are_whole(spark, tmp_path):
    location = str(tmp_path / "log")
    filelog.create_log(spark, location)
    filelog.create_log(spark, location)
    schema = "path string, size_bytes bigint, token_count bigint, indexed_at bigint"
    filelog.append_log(spark.createDataFrame([("a", 1, 1, 1)], schema), location)
    filelog.append_log(spark.createDataFrame([], schema), location)
    broken = spark.createDataFrame([(f"b{n}", n, 1, 1) for n in range(50)] + [("c", None, 1, 1)], schema)
    with pytest.raises(Exception, match="size_bytes must not be null"):
        filelog.append_log(broken.repartition(4), location)
    assert rows(filelog.read_log(spark, location)) == [("a", 1, 1, 1)]


def test_log_time_is_in_seconds(spark, tmp_path):
    session = IndexSession(spark, log=str(tmp_path / "log"))
    session.index_table(table(spark, {"a.txt": "one"}))
    now = spark.range(1).select(F.unix_timestamp()).first()[0]
    assert 0 <= now - session.log().first()["indexed_at"] < 600


def test_one_word_and_one_file_dominate(spark):
    """A third of all tokens is one word; one file is far larger than the rest."""
    texts = {f"r/f{n:03d}.txt": f"hot hot w{n} v{n % 5}" for n in range(300)}
    texts["r/large.txt"] = "hot " * 5000 + " ".join(f"u{n}" for n in range(3000))
    session = IndexSession(spark)
    session.index_table(table(spark, texts))
    counts = brute_force(texts)
    assert {(w, p): n for w, p, n in rows(session.snapshot())} == counts
    top = session.search("hot", limit=2).collect()
    assert [(r["path"], r["score"]) for r in top] == [("r/large.txt", 5000), ("r/f000.txt", 2)]
    queries = spark.createDataFrame([(n, "hot") for n in range(10)] + [(99, "w7 v2")], "q int, t string")
    assert session.search_batch(queries, "q", "t").count() == 10 * 301 + 60
    assert session.search_batch(queries, "q", "t", limit=7).count() == 10 * 7 + 7
    best = session.search_batch(queries, "q", "t", limit=1).where("query_id < 10")
    assert {(r["path"], r["rank"]) for r in best.collect()} == {("r/large.txt", 1)}
    plain = postings(corpus_from_table(table(spark, texts)))
    assert posting_differences(plain, session.snapshot()).isEmpty()


def test_stored_index_is_clustered_and_filters_reach_it(spark):
    session = IndexSession(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        session.index_table(
            table(spark, {f"f{n}.txt": f"the w{n % 400} x{n}" for n in range(2000)})
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(session._location)
    order = stored.select(
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "word", "path"
    ).collect()
    files = {}
    for row in sorted(order, key=lambda r: r["at"]):
        files.setdefault(row["file"], []).append((row["word"] or "", row["path"]))
    assert all(keys == sorted(keys) for keys in files.values())
    ranges = sorted((keys[0], keys[-1]) for keys in files.values())
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))

    plan = session.search("w7 w8")._jdf.queryExecution().executedPlan().toString()
    assert "Or(EqualTo(word,w7),EqualTo(word,w8))" in plan
    assert "ReadSchema: struct<word:string,path:string,frequency:bigint>" in plan
    plan = session.files()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(word)]" in plan


def rows_read(df):
    """Rows that the scan of a search hands on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        elif "QueryStage" in plan.nodeName():
            plan = plan.plan()
        else:
            plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_rows_read_grow_with_the_terms_and_not_with_their_range(spark):
    session = IndexSession(spark)
    docs = spark.range(40_000).select(
        F.format_string("f%06d.txt", "id").alias("path"),
        F.concat_ws(" ", *[F.format_string(f"{c}%06d", "id") for c in "abcdefghij"]).alias("text"),
    )
    session.index_table(docs, partitions=8)
    total = session.snapshot().count()
    assert total == 400_000
    read = {}
    for count in (2, 11, 600):
        words = [f"{'abcdefghij'[n % 10]}{n * 40_000 // count // 10:06d}" for n in range(min(count, 10))]
        words += [f"c{n:06d}" for n in range(count - len(words))]
        query = session.search(" ".join(words))
        read[count] = rows_read(query)
        assert query.count() > 0
    # A page holds 20,000 rows at most: 2 terms touch 2 pages, 11 touch 11, 600 few more.
    assert read[2] <= 2 * 20_000 and read[11] <= 11 * 20_000 and read[600] <= 13 * 20_000


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("regexp_extract_all") <= 1, "tokens are extracted twice"
    return final.count("Exchange hashpartitioning"), final.count("Exchange rangepartitioning")


def test_shuffles_of_the_main_jobs(spark, tmp_path):
    """Without a layout of its own, the text itself is never shuffled."""
    texts = {f"f{n}.txt": f"the w{n % 40} x{n}" for n in range(500)}
    table(spark, texts).write.parquet(str(tmp_path / "t"))
    corpus = corpus_from_table(spark.read.parquet(str(tmp_path / "t")))
    assert shuffles(file_token_counts(corpus)) == (1, 0)
    assert shuffles(postings(corpus.repartition("path"))) == (1, 0)
    assert shuffles(postings(corpus)) == (1, 0)
    assert shuffles(ledger(corpus)) == (1, 0)
    assert shuffles(index_stats(corpus)) == (1, 0)
    assert shuffles(search_text(corpus, "the w1", limit=3)) == (0, 0)
    assert shuffles(search_text(corpus, "the w1")) == (1, 1)
    session = IndexSession(spark)
    session.index_corpus(corpus)
    assert shuffles(session.search("the", limit=3)) == (0, 0)
    assert shuffles(session.search("the w1", limit=3)) == (1, 0)


def test_prints_tell_postings_apart(spark, tmp_path):
    texts = {f"f{n}.txt": f"one two w{n} one" for n in range(30)}
    session = IndexSession(spark, workspace=str(tmp_path))
    with pytest.raises(RuntimeError):
        session.compare_postings()
    session.index_table(table(spark, texts), run_id="a")
    session.index_table(table(spark, texts).repartition(5), run_id="b")
    # The six statistics of this one are those of the others.
    session.index_table(table(spark, {**texts, "f1.txt": "one two w2 one", "f2.txt": "one two w1 one"}), run_id="c")
    assert {r["run_id"]: r["equivalent"] for r in session.compare().collect()} == {"a": True, "b": True, "c": True}
    assert dict(rows(session.compare_postings())) == {"a": True, "b": True, "c": False}
    prints = rows(fingerprint(session.snapshot()))
    assert prints == [session._prints[-1][1]]
    empty = IndexSession(spark, workspace=str(tmp_path))
    empty.index_table(table(spark, {"a.bin": "x"}))
    assert rows(fingerprint(empty.snapshot())) == [empty._prints[0][1]] == [(0, 0, None, None)]


def test_differences_are_worked_out_only_if_prints_disagree(spark):
    index = postings(corpus_from_table(table(spark, {f"f{n}.txt": f"one two w{n}" for n in range(20)})))
    assert differing_postings(index, index.repartition(3)).isEmpty()
    lost = index.where("word != 'w7'")
    swapped = index.withColumn("frequency", F.when(F.col("word") == "w3", 2).otherwise(F.col("frequency")))
    assert set(rows(differing_postings(index, lost))) == {("w7", "f7.txt", 1, 1)}
    assert differing_postings(index, swapped).count() == 2
    assert rows(differing_postings(index.where("false"), index.where("false"))) == []


def test_two_sessions_publish_and_one_wins(spark, tmp_path):
    work = str(tmp_path)
    with pytest.raises(ValueError):
        IndexSession.open(spark, workspace=work)
    first = IndexSession(spark, workspace=work)
    with pytest.raises(RuntimeError):
        first.publish()
    first.index_table(table(spark, {"a.txt": "one"}))
    assert first.publish() == 1
    other = IndexSession.open(spark, workspace=work)
    assert rows(other.search("one")) == [("a.txt", 1, 1, 1)] and rows(other.stats()) == rows(first.stats())
    first.index_table(table(spark, {"b.txt": "one one"}))
    other.index_table(table(spark, {"c.txt": "one one one"}))
    assert first.publish() == 2
    with pytest.raises(RuntimeError, match="another session"):
        other.publish()
    assert [r["path"] for r in other.search("one").collect()] == ["c.txt"]
    # Both stay readable, also after their sessions let go of them.
    first.clear()
    other.clear()
    assert [r["path"] for r in IndexSession.open(spark, workspace=work).search("one").collect()] == ["b.txt"]
    earlier = IndexSession.open(spark, workspace=work, generation=1)
    assert [r["path"] for r in earlier.search("one").collect()] == ["a.txt"]
    again = IndexSession.open(spark, workspace=work)
    again.index_table(table(spark, {"d.txt": "one"}))
    assert again.publish() == 3
    assert dict(rows(again.compare_postings()))[again._runs[0][0]]
    with pytest.raises(ValueError):
        IndexSession.open(spark, workspace=work, generation=9)


def test_log_batches_count_once_they_are_in_the_manifest(spark, tmp_path):
    location = str(tmp_path / "log")
    schema = "path string, size_bytes bigint, token_count bigint, indexed_at bigint"
    filelog.create_log(spark, location)
    filelog.append_log(spark.createDataFrame([("a", 1, 1, 1)], schema), location)
    # A writer that died after its rows and before its entry.
    spark.createDataFrame([("lost", 1, 1, 1)], schema).write.parquet(f"{location}/batch=dead")
    # One that died inside its entry.
    (tmp_path / "log/_batches/000000000099.json").write_text("")
    assert rows(filelog.read_log(spark, location)) == [("a", 1, 1, 1)]
    filelog.append_log(spark.createDataFrame([("b", 1, 1, 1)], schema), location)
    assert sorted(r["path"] for r in filelog.read_log(spark, location).collect()) == ["a", "b"]
    assert len(list((tmp_path / "log/_batches").glob("*.json"))) == 4


def test_log_writers_that_come_at_once(spark, tmp_path):
    location = str(tmp_path / "log")
    schema = "path string, size_bytes bigint, token_count bigint, indexed_at bigint"
    filelog.create_log(spark, location)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: filelog.append_log(spark.createDataFrame([(f"p{n}", 1, 1, 1)], schema), location), range(8)))
    assert sorted(r["path"] for r in filelog.read_log(spark, location).collect()) == [f"p{n}" for n in range(8)]


def test_a_large_table_is_cut_into_ranges_by_a_sample(spark, monkeypatch):
    """Many parts: rows are computed once, in ranges that follow one another and are alike in size."""
    monkeypatch.setattr(sizing, "COUNTED_BYTES", 4000)
    monkeypatch.setattr(ranges, "COUNTED_BYTES", 4000)
    texts = {f"f{n:04d}.txt": f"the w{n % 400:03d} x{n:04d} y{n % 7}" for n in range(2000)}
    texts |= {"none.md": "", "other.bin": "skipped", "long.txt": "the " * 500 + "end"}
    session = IndexSession(spark)
    documents = spark.createDataFrame([*texts.items(), ("null.txt", None)], "path string, text string")
    session.index_table(documents)
    wanted = brute_force({path: text for path, text in texts.items() if path != "other.bin"})
    assert {(w, p): n for w, p, n in rows(session.snapshot())} == wanted
    stats = session.stats().first().asDict()
    assert (stats["discovered"], stats["indexed"], stats["skipped"]) == (2004, 2002, 2)
    told = spark.read.parquet(f"{session._location}/_directory").orderBy("first_word").collect()
    assert len(told) > 8
    spans = [(r["first_word"], r["last_word"]) for r in told if r["first_word"] is not None]
    assert all(one[1] <= other[0] for one, other in zip(spans, spans[1:]))
    sizes = [r["words"] + r["words_missing"] for r in told]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    assert rows(session.postings("the")) and session.files().count() == 2004
    with pytest.raises(ValueError, match="more than once"):
        session.index_table(documents.unionAll(documents))


def test_whole_texts_are_counted_without_a_row_per_token(spark, monkeypatch):
    """What is counted in a task is the ledger, and its ranges are those that ``ranged`` tells."""
    monkeypatch.setattr(counted, "HELD_POSTINGS", 50)
    monkeypatch.setattr(counted, "BATCH_ROWS", 7)
    texts = {f"f{n:03d}.txt": f"The w{n % 40} \u212a x{n} the-end caf\u00e9{n} The" for n in range(200)}
    texts |= {"none.md": "", "other.bin": "skipped", "marks.txt": "\u00e9 -- \u4e2d", "z\u00e9.txt": "the Zz0"}
    documents = spark.createDataFrame([*texts.items(), ("null.txt", None), ("a", None)], "path string, text string")
    corpus = corpus_from_table(documents)
    bounds = sorted(["\0f010.txt", "\0zz", "the\0f100.txt", "the\0f1", "thf\0a", "w5\0", "zz0\0z\u00e9.txt", "zzz\0a"])
    found = counted.counted_ledger(corpus.repartition(3, "path"), bounds, False)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    wanted = ranges.ranged(ledger(corpus), bounds)
    assert sorted(map(str, rows(found))) == sorted(map(str, rows(wanted.select(*found.columns))))


def test_long_texts_and_rows_without_a_path_are_in_a_large_index(spark, monkeypatch):
    monkeypatch.setattr(sizing, "COUNTED_BYTES", 4000)
    monkeypatch.setattr(ranges, "COUNTED_BYTES", 4000)
    monkeypatch.setattr(counted, "WHOLE_BYTES", 1000)
    texts = {f"f{n:04d}.txt": f"the w{n % 400:03d} x{n:04d} y{n % 7}" for n in range(2000)}
    texts |= {"long.txt": "the " * 500 + "end", "more.md": "the x0001 " * 300}
    rows_of = [*texts.items(), (None, "the lost the")]
    session = IndexSession(spark)
    session.index_table(spark.createDataFrame(rows_of, "path string, text string"))
    wanted = brute_force(texts)
    assert {(w, p): n for w, p, n in rows(session.snapshot().where(F.col("path").isNotNull()))} == wanted
    # A row without a path has no suffix and so is no file that is indexed.
    assert session.snapshot().where(F.col("path").isNull()).count() == 0
    assert session.stats().first()["discovered"] == len(rows_of)


def test_a_batch_shuffles_a_posting_once(spark):
    """What is shuffled does not grow with the queries that share a word."""
    texts = {f"f{n:03d}.txt": f"the and w{n % 9}" for n in range(300)}
    session = IndexSession(spark)
    session.index_table(table(spark, texts))
    most = {}
    for number in (5, 50):
        queries = spark.createDataFrame([(n, "the and") for n in range(number)], "q int, t string")
        found = session.search_batch(queries, "q", "t")
        assert found.count() == number * 300
        plan = found._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        most[number] = max(shuffle_rows(plan))
    assert most[5] == most[50] == 600


def test_pieces_of_files_are_counted_where_they_are(spark, tmp_path):
    """What is stored of each row adds up to the ledger, whatever the rows of a path are."""
    rows = [
        ("a.txt", 9, "eligible", None, "One two, one", 0),
        ("b.txt", 30, "eligible", None, "\u00e9 three one ", 0),
        ("b.txt", 30, "eligible", None, "three x" * 400_000, 1),
        ("late.txt", 8, "eligible", None, "some words", 0),
        ("late.txt", 8, "eligible", "OSError: gone", None, 1),
        ("twice.txt", 1, "eligible", None, "q", 0),
        ("twice.txt", 1, "eligible", None, "q r", 0),
        ("gone.txt", None, "inaccessible", "OSError: no", None, 0),
        ("c.bin", 4, "skipped", None, None, 0),
        ("empty.md", 0, "eligible", None, "", 0),
        (None, 2, "eligible", None, "ab", 0),
        (None, 2, "eligible", None, "ab", 0),
    ]
    schema = "path string, size_bytes bigint, status string, error string, text string, piece int"
    for at, some in enumerate((rows, rows[:1] + rows[8:11], [])):
        corpus = spark.createDataFrame(some, schema).repartition(3, "text")
        counted.count_pieces(corpus, f"{tmp_path}/{at}")
        wanted, found = ledger(corpus), counted.ledger_of_pieces(spark, f"{tmp_path}/{at}")
        assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
        assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_ranges_of_files_are_cut_from_stored_rows(spark, tmp_path, monkeypatch):
    """Spark computes rows once more to find where to cut them, so these must not be counted there."""
    for number in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/f{number}.txt").write_text("some words " * number)
    plans, write = [], session_module.write_index

    def seen(entries, *more):
        plans.append(entries._jdf.queryExecution().optimizedPlan().toString())
        return write(entries, *more)

    monkeypatch.setattr(session_module, "write_index", seen)
    session = IndexSession(spark, str(tmp_path / "work"))
    assert tuple(session.index_store(str(tmp_path / "in")).first()) == (3, 3, 0, 0, 2, 6)
    assert "parquet" in plans[0] and not any(part in plans[0] for part in ("Aggregate", "MapInArrow", "Generate"))
    assert not list((tmp_path / "work").glob("*counted*"))
