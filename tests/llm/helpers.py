"""Documents with every awkward case, and plain versions of what operators compute."""

import re

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potent tea".split()


def prose(seed, words):
    return " ".join(WORDS[(seed * 7 + at * at + at * seed) % len(WORDS)] + str((seed + at) % 5) for at in range(words))


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = prose(3, 6000) + "\n" + "x" * 20_000 + " 4111 1111 1111 1111 " + "a" * 5000 + "@b.co"
    return [
        (1, prose(1, 40), "en", "web", 10),
        (2, None, "en", "web", None),
        (3, "", "de", "web", 0),
        (4, " \n\t ", None, "web", 4),
        (5, long_text, "en", "books", 9),
        (6, prose(1, 40), "en", None, 10),
        (7, prose(2, 30), None, "news", 10),
        (7, prose(2, 30), None, "news", 10),
        (None, "Ünïcödé text ohne Nummer, mail me: né@e.x joe@example.org", "de", None, 1),
        (None, None, None, None, None),
        (9, "123 456 !!! ...", "fr", "news", 1),
        (10, "one", "en", "news", 1),
        (11, "emoji 😀 call +49 (30) 123-456-78 or 10.0.0.1 today", "en", "news", 1),
    ]


def awkward(spark, extra=()):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3, "doc_id")
    for name in extra:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fold(text):
    """A-Z to lower case, nothing else."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
