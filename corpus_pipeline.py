"""From raw documents to packed training sequences.

Each stage works on everything its predecessor kept: its input is the Parquet
table that the stage before it wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import language, mixing, neardup, packing, pii
from wordloom.llm.queries import BYTE_BPE, END_ID
from wordloom.llm.scratch import shared_folder

#: Bytes of words that a worker keeps while it packs, next to what is left of the other stages.
KEPT_BYTES = 16 << 20

#: Rows that go to a worker at once. Spark's 10,000 whole texts are tens of MB, which an
#: executor holds for each worker several times over, and its workers once more.
BATCH_ROWS, _BATCH_ROWS = 1024, "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Bound the batches of the session, unless it has smaller ones. They change no result."""
    rows = int(spark.conf.get(_BATCH_ROWS))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, which those without a language get; texts without a letter go.

    No document goes for a low score: the score tells how sure the model is, not
    whether the text is any good. Where no labelled document is left to fit on, no language can be told, and
    still only texts without a letter go.
    """
    _small_batches(spark)
    return language.identified_documents(docs, language.fitted(docs), lang="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    _small_batches(spark)
    return neardup.deduplicated(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind; null and empty texts stay as they are."""
    return _counted(pii.redact(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for.

    Null and empty texts weigh nothing and are taken by their place in the order
    of their source. A null source is a source of its own; an empty table stays empty.
    """
    return _counted(mixing.mixed_documents(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as pieces of sequences of at most 1024 tokens.

    A null or empty text is the one piece of its end; texts of any length are
    cut, never left out; an empty table gives no piece.
    """
    _small_batches(spark)
    return packing.packed_documents(docs, public_tokenizers.path(BYTE_BPE), END_ID, kept_bytes=KEPT_BYTES)


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """Bring ``n_chars`` in line with the text again, where there is such a column."""
    if "n_chars" not in docs.columns:
        return changed
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: No SQL: languages come from a fitted model and packing from an optimisation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
