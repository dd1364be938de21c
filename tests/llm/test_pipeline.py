import sys
from collections import Counter

import pytest
from helpers import WORDS, awkward, prose
from pyspark.sql import functions as F

import corpus_pipeline
from wordloom.llm import pii, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, tmp_path):
    docs = awkward(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def stage(spark, name, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "pack"]


def test_awkward_rows_through_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = seen[name] = spark.read.parquet(f"{folder}/{name}")
        assert name == "pack" or docs.columns == columns
    ids = {name: sorted(row["doc_id"] or 0 for row in df.collect()) for name, df in seen.items()}
    # Without a letter: 2, 3, 4, 9 and the row of nulls. 6 repeats 1, 7 itself.
    assert ids["language"] == [0, 1, 5, 6, 7, 7, 10, 11]
    assert ids["near_duplicates"] == ids["personal_data"] == [0, 1, 5, 7, 10, 11]
    clean = seen["near_duplicates"].where("doc_id = 7").first()
    assert clean["text"] == prose(2, 30)
    assert seen["personal_data"].where("doc_id = 7").first()["text"] == clean["text"]
    assert all("4111" not in row["text"] for row in seen["personal_data"].collect())
    assert pii.find_pii(seen["personal_data"]).where("size(spans) > 0").count() == 0
    packed = seen["pack"].collect()
    tokens = Counter()
    for row in packed:
        tokens[row["sequence_id"]] += row["length"]
    assert max(tokens.values()) <= 1024
    assert {row["doc_id"] or 0 for row in packed} == set(ids["mix"])


def test_run_writes_and_rereads_every_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert out.count() > 0


def test_clean_rows_stay_without_any_label(spark):
    docs = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = stage(spark, "language", docs, "")
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] or 0 for row in kept.collect()) == [0, 1, 5, 6, 7, 7, 10, 11]


def similarity(one, other, words=5):
    sets = [{tuple(text.split()[at : at + words]) for at in range(len(text.split()) - words + 1)} for text in (one, other)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_copies_and_near_copies_go(spark, tmp_path):
    # Words that never repeat in order, so that each shingle is there once.
    words = [f"{WORDS[(at * at) % len(WORDS)]}{at}" for at in range(200)]
    first, near = " ".join(words), " ".join([*words[:100], "other", *words[101:]])
    clean = " ".join([*words[:90], *[f"new{at}" for at in range(110)]])
    assert similarity(first, near) >= 0.9 and similarity(first, clean) < 0.5 and similarity(near, clean) < 0.5
    rows = [(1, first), (2, first), (3, near), (4, clean)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    kept = stage(spark, "near_duplicates", docs, "")
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 4]


def test_clashing_names_and_maps_do_not_stop_the_near_duplicates(spark):
    rows = [(1, prose(1, 40), {"b": 2}), (1, prose(1, 40), {"a": 1}), (2, prose(1, 40), {"a": 1}), (3, prose(5, 60), None), (None, "", {})]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, notes map<string,int>")
    for name in ("gone_key", "again_key", "key", "row", "row_key", "stays", "times", "n", "a.b"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    kept = stage(spark, "near_duplicates", docs, "")
    assert kept.columns == docs.columns
    found = sorted(((row["doc_id"], row["notes"], row["gone_key"]) for row in kept.collect()), key=repr)
    assert found == [(1, {"a": 1}, "clash"), (3, None, "clash"), (None, {}, "clash")]


def test_empty_table_through_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_give_rows_for_every_input(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    rows = df.collect()
    if name in ("op12_spelling_variants", "op13_warc"):
        assert rows
        return
    if "embeddings" in (queries.QUERIES[name].__code__.co_consts or ()):
        assert rows
        return
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert {row["doc_id"] for row in rows} == {row["doc_id"] for row in docs.select("doc_id").collect()}
    if name != "op10_packing":
        assert len(rows) == docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.01/{table}.parquet'")
    wanted = con.sql(queries.ORACLE_SQL[name])
    found = queries.QUERIES[name](spark, "/root/testdata/sf0.01")
    assert sorted(found.columns) == sorted(wanted.columns)
    rows = [tuple(row) for row in found.select(*wanted.columns).collect()]
    assert sorted(rows, key=repr) == sorted(wanted.fetchall(), key=repr)


def test_nothing_else_imports_the_operators():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent / "wordloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
    assert "corpus_pipeline" in sys.modules


def test_documents_without_a_language_get_the_one_that_is_told(spark):
    words = {"en": "the and with from that this", "de": "der und mit von dass dieses"}
    rows = [(n, f"{words[lang]} {n}", lang) for n, lang in enumerate(["en", "de"] * 30)]
    rows += [(100, "with this and that", None), (101, "mit dieses und dass", None), (102, "mit dass und", "en"), (103, "1 2", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'s' AS source", "1L AS n_chars")
    kept = stage(spark, "language", docs, "")
    assert kept.columns == docs.columns
    found = {row["doc_id"]: row["lang"] for row in kept.collect()}
    assert {n: found.get(n) for n in (100, 101, 102, 103)} == {100: "en", 101: "de", 102: "en", 103: None}
    assert len(found) == 63 and 103 not in found


@pytest.mark.parametrize("name", ["language", "near_duplicates", "pack"])
@pytest.mark.parametrize("before, after", [("10000", "1024"), ("100", "100"), ("0", "1024")])
def test_workers_get_whole_texts_in_small_batches(spark, folder, name, before, after):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(rows)
    try:
        spark.conf.set(rows, before)
        stage(spark, name, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert spark.conf.get(rows) == after
    finally:
        spark.conf.set(rows, usual)
