import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, awkward_rows, empty
from pyspark.sql import functions as F

from wordloom.llm import language

SMALL = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet(SMALL)
    found = language.identify(docs, language.fitted(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out(F.col("doc_id"))).collect()
    right = sum(row["lang_pred"] == row["lang"] for row in rows)
    assert len(rows) > 300 and right / len(rows) >= 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_labels_and_ids_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(SMALL)
    turned = docs.withColumn(
        "lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))
    )
    first, second = (language.identify(docs, language.fitted(d)).collect() for d in (docs, turned))
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_held_out_is_the_checksum_of_the_id(spark):
    rows = spark.range(200).select("id", language.held_out(F.col("id")).alias("out")).collect()
    assert all(row["out"] == (zlib.crc32(str(row["id"]).encode()) % 3 == 1) for row in rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    docs = awkward(spark, ["lang_pred", "score", "gram"])
    found = language.identify(docs, language.fitted(docs)).collect()
    assert len(found) == len(rows)
    by_id = {row["doc_id"]: row for row in found}
    for doc_id in (2, 3, 4, 9):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == ("und", 0.0)
    learned = {lang for doc_id, text, lang, *_ in rows if lang and text is not None}
    assert {row["lang_pred"] for row in found} <= learned | {"und"}


def test_nothing_to_learn_from(spark):
    docs = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    found = language.identify(docs, language.fitted(docs)).collect()
    assert {row["lang_pred"] for row in found} == {"und"}
    assert language.identify(empty(spark), language.fitted(empty(spark))).collect() == []


def test_unseen_words_fall_back_to_shorter_grams():
    counts = [("aa", 0, "known", 5), ("bb", 0, "other", 5), ("aa", 4, "abcd", 9), ("bb", 4, "efgh", 9)]
    counts += [("bb", 3, "xyz", 9), ("aa", 3, "uvw", 9), ("bb", 1, "q", 9), ("aa", 1, "r", 9)]
    model = language.Model.from_counts(counts)
    assert model.predict("known known")[0] == "aa"
    assert model.predict("zzabcdzz")[0] == "aa" and model.predict("zzefghzz")[0] == "bb"
    assert model.predict("wxyzw")[0] == "bb" and model.predict("q")[0] == "bb"
    assert model.word_scores("mmm").tolist() == [0, 0]
    again = language.Model.load(model.dump())
    assert again.langs == ["aa", "bb"] and again.predict("wxyzw")[0] == "bb"


def test_unspaced_runs_count_as_a_whole(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", "bb"]), pa.array(["n" * 70 + "uvwx", "n" * 70 + "efgh"])], ["lang", "text"])

    def counts():
        added = Counter()
        for part in language._count(iter([batch])):
            for lang, size, gram, n in zip(*(column.to_pylist() for column in part.columns)):
                added[lang, size, gram] += n
        return added

    whole = counts()
    assert whole["bb", 4, "efgh"] == whole["bb", 4, "fgh_"] == 1 and whole["bb", 2, "nn"] == 69
    model = language.Model.from_counts([(*key, n) for key, n in whole.items()])
    for length in (65, 100, 5000):
        assert model.predict("n" * length + "zefghz")[0] == "bb" and model.predict("n" * length + "zuvwxz")[0] == "aa"
    scores = model.word_scores("nefgh" * 30)
    monkeypatch.setattr(language, "_GRAM_BLOCK", 7)
    monkeypatch.setattr(language, "_COUNTED_GRAMS", 3)
    assert counts() == whole and abs(model.word_scores("nefgh" * 30) - scores).max() < 1e-12


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(language, "_KEPT_WORDS", 3)
    model = language.Model.from_counts([("aa", 1, "a", 5), ("bb", 1, "b", 5)])
    assert model.predict(" ".join("ab"[n % 2] * n for n in range(1, 40)))[0] in ("aa", "bb")
    assert len(model._rows) == 3
    texts = ["a b ab ba", "bb aa b", "a"]
    assert [model.predict(t) for t in texts] == [language.Model.from_counts([("aa", 1, "a", 5), ("bb", 1, "b", 5)]).predict(t) for t in texts]


def test_stage_keeps_columns_and_clean_rows(spark):
    docs = awkward(spark, ["lang_pred"])
    kept = language.identified_documents(docs, language.fitted(docs))
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] or 0 for row in kept.collect()) == [0, 1, 5, 6, 7, 7, 10, 11]


def test_numerals_are_no_letters():
    assert language.words_of("x² ½ Ⅷ ³ ٣ a1b Été") == ["x", "a", "b", "été"]
    model = language.Model.from_counts([("en", 0, "x", 3), ("de", 0, "y", 3)])
    for text in ("² ½ Ⅷ", "", None, "12 !"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("x² ½")[0] == "en"


def test_predictions_equal_a_plain_scorer(spark):
    """The backoff written out with dictionaries, on texts of the given table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    tables = {size: {gram: logs[row] for gram, row in known.items()} for size, (known, logs) in model._tables.items()}

    def score(word):
        if word in tables[0]:
            return tables[0][word]
        for size in (4, 3, 2, 1):
            marked = word if size == 1 else f"_{word}_"
            grams = [marked[at : at + size] for at in range(len(marked) - size + 1)]
            known = [tables[size][gram] for gram in grams if gram in tables[size]]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(model.langs))

    for row in docs.collect():
        words = ["".join(group) for alpha, group in itertools.groupby((row["text"] or "").lower(), str.isalpha) if alpha]
        lang, value = model.predict(row["text"])
        if not words:
            assert (lang, value) == ("und", 0.0)
            continue
        mean = np.mean([score(word) for word in words], axis=0)
        odds = np.exp(mean - mean.max())
        assert lang == model.langs[int(mean.argmax())]
        assert value == pytest.approx(odds.max() / odds.sum(), rel=1e-9)


def test_scores_of_many_words_are_those_of_each(monkeypatch):
    counts = [("en", 0, "word", 3), ("de", 4, "_wor", 2), ("de", 3, "abc", 2), ("en", 2, "zz", 5), ("en", 1, "q", 1)]
    model = language.Model.from_counts(counts)
    words = ["word", "worx", "xabcabc", "zzzzz", "qq", "nnn", "w" * 40, "abc" * 30]
    for block in (1 << 16, 10, 5):
        monkeypatch.setattr(language, "_GRAM_BLOCK", block)
        found = model.scores_of(words)
        assert np.allclose(found, [model.word_scores(word) for word in words], atol=1e-12)
    assert language.Model([], {}).scores_of(["a"]).shape == (1, 0)
