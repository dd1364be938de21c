"""The operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import ann, language, licenses, maxscore, mixing, neardup, packing, pii, separators, spelling, token_files, warc, whitening

#: Vocabularies of the queries.
BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_MULTI = "byte_bpe_multi_50k.tiktoken"
#: Id that closes a document in token files and sequences.
END_ID = 2
#: Fixed value: the one id that the multilingual vocabulary leaves free.
FREE_ID = 50256
#: Words of a shingle in the near-duplicate query.
QUERY_SHINGLE_WORDS = 2

_BASE_KINDS = ("email", "ip", "card", "phone")


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_token_files(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    return token_files.token_file_rows(docs, public_tokenizers.path(BYTE_BPE), END_ID)


def op2_nearest_vectors(spark: SparkSession, directory: str) -> DataFrame:
    return ann.nearest(_table(spark, directory, "embeddings"), k=10, every=100)


def op3_personal_data(spark: SparkSession, directory: str) -> DataFrame:
    found = pii.find_pii(_table(spark, directory, "documents"))
    kinds = F.transform("spans", lambda span: span["kind"])

    def count(kind: str):
        return F.size(F.filter(kinds, lambda one: one == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in _BASE_KINDS],
        F.sha2(pii.digest(F.col("spans"), _BASE_KINDS), 256).alias("base_sha256"),
        pii.digest(F.col("spans"), tuple(kind.name for kind in pii.KINDS)).alias("spans"),
        F.array_max(F.transform("spans", lambda span: span["score"])).alias("best_score"),
    )


def op4_languages(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    predicted = language.identify(docs, language.fitted(docs))
    return predicted.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    groups = neardup.near_duplicates(docs, words=QUERY_SHINGLE_WORDS)
    return groups.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("stays").alias("kept"),
    )


def op6_best_products(spark: SparkSession, directory: str) -> DataFrame:
    return maxscore.best_products(_table(spark, directory, "embeddings"), k=20, every=20)


def op7_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    rows = separators.flat_token_rows(docs, public_tokenizers.path(BYTE_BPE_MULTI), FREE_ID)
    return rows.select("doc_id", "n_tokens")


def op8_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(_table(spark, directory, "documents"))


def op9_licenses(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, directory, "documents"))


def op10_packing(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    return packing.packed_documents(docs, public_tokenizers.path(BYTE_BPE), END_ID)


def op11_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whitening.whitened(_table(spark, directory, "embeddings"), most=4)


def op12_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, directory, "documents"))


def op13_warc(spark: SparkSession, directory: str) -> DataFrame:
    return warc.archived_pages(_table(spark, directory, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_nearest_vectors": op2_nearest_vectors,
    "op3_personal_data": op3_personal_data,
    "op4_languages": op4_languages,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_best_products": op6_best_products,
    "op7_token_counts": op7_token_counts,
    "op8_source_mix": op8_source_mix,
    "op9_licenses": op9_licenses,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_warc": op13_warc,
}

_PRODUCTS = """
WITH rows_in AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM rows_in q JOIN rows_in c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20"""

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1-' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ([5, 2, 1])[1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight
  FROM sized GROUP BY source
),
-- A level at which a source is full is found source by source, in order of cap per weight.
leveled AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER w AS place,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM sources WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
),
first_open AS (SELECT min(place) AS place FROM leveled WHERE left_over * weight <= cap * weights_left),
goals AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.place < o.place THEN CAST(l.cap AS DOUBLE)
              ELSE CAST(s.left_over * l.weight AS DOUBLE) / CAST(s.weights_left AS DOUBLE) END AS target
  FROM leveled l, first_open o, leveled s WHERE s.place = o.place
),
running AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target) AS BIGINT) // g.source_size ELSE 0 END AS epochs,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS through
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * epochs + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - (through - size))) AS BIGINT) AS taken
FROM running"""

ORACLE_SQL: dict[str, str] = {
    "op6_best_products": _PRODUCTS,
    "op8_source_mix": _MIX,
}
