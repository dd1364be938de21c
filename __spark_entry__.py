"""Entry points of the check: the flagship query, all queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.plans import catalog

SMOKE_DIRECTORY = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Build postings of the documents and search them, best file first."""
    return catalog.search_all(spark, SMOKE_DIRECTORY)


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, if that part is there."""
    try:
        import corpus_pipeline
        from wordloom.llm import queries as llm
    except ImportError:
        return {}, {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, dict(llm.ORACLE_SQL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**catalog.QUERIES, **_training_data()[0]}


# The view of FIXTURES.md section 1, and the parts built on it. Numbers and words
# are written out here, so that a slip in the catalogue shows.
def _path(suffixes: str, count: int) -> str:
    return f"""'corpus/' || source || CASE WHEN (doc_id // 20) % 2 = 1 THEN '-b' ELSE '' END
    || '/document-' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(6, length(CAST(doc_id AS VARCHAR))) AS INT), '0')
    || ({suffixes})[CAST(doc_id % {count} AS INT) + 1]"""


_SUPPORTED = r"regexp_matches(lower(path), '[^/]\.(txt|md|log|csv)$')"

_SCANNED = f"""
files AS (
  SELECT {_path("['.txt', '.MD', '.log', '.csv', '.bin', '']", 6)} AS path,
         octet_length(encode(text)) AS size_bytes, text, source, doc_id
  FROM documents
),
classified AS (
  SELECT *, CASE WHEN {_SUPPORTED} AND size_bytes <= 7000
                 THEN 'eligible' ELSE 'skipped' END AS status
  FROM files
)"""

_FILES = f"""
files AS (
  SELECT {_path("['.txt', '.MD', '.log', '.csv']", 4)} AS path,
         octet_length(encode(text)) AS size_bytes, text, source, doc_id
  FROM documents
)"""

_TOKENS = "regexp_extract_all({0}, '[0-9A-Za-z]+')"


def _postings(of: str) -> str:
    return f"""
postings AS (
  SELECT word, path, count(*) AS frequency
  FROM (SELECT path, lower(unnest({_TOKENS.format('text')})) AS word FROM {of})
  GROUP BY word, path
)"""


_INDEX = f"{_FILES},{_postings('files')}"

_TERMS = f"""
terms AS (
  SELECT DISTINCT item_id AS query_id, lower(unnest({_TOKENS.format('text')})) AS word
  FROM benchmark
)"""


def _search(query: str) -> str:
    return f"""
hits AS (
  SELECT path, CAST(sum(frequency) AS BIGINT) AS score,
         CAST(sum(frequency) AS BIGINT) AS total_matches, count(*) AS matched_terms
  FROM postings
  JOIN (SELECT DISTINCT lower(unnest({_TOKENS.format(f"'{query}'")})) AS word) USING (word)
  GROUP BY path
)"""


def _search_sql(query: str) -> str:
    return f"WITH {_INDEX},{_search(query)} SELECT * FROM hits"


_STATS = f"""{_INDEX},
stats AS (
  SELECT (SELECT count(*) FROM files) AS discovered,
         (SELECT count(*) FROM files) AS indexed,
         CAST(0 AS BIGINT) AS failed,
         CAST(0 AS BIGINT) AS skipped,
         (SELECT count(DISTINCT word) FROM postings) AS unique_words,
         (SELECT CAST(sum(frequency) AS BIGINT) FROM postings) AS total_tokens
)"""

_BATCH = f"""{_FILES},{_postings('files')},{_TERMS},
matched AS (
  SELECT query_id, path, CAST(sum(frequency) AS BIGINT) AS score,
         CAST(sum(frequency) AS BIGINT) AS total_matches, count(*) AS matched_terms
  FROM postings JOIN terms USING (word)
  GROUP BY query_id, path
)"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_ARGUMENTS = """
arguments AS (
  SELECT doc_id,
    (['', chr(9) || ' ', '"', ' ''', '''', '"" ', chr(11) || chr(12), chr(160)])
      [CAST(doc_id % 8 AS INT) + 1]
    || text ||
    (['', ' ' || chr(13) || chr(10), '"', '''' || chr(9), '"', ' ""', chr(10), chr(160)])
      [CAST(doc_id % 8 AS INT) + 1] AS argument
  FROM documents
)"""

_RANKED = f"""WITH {_BATCH}
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, path) AS rank
            FROM matched"""


def _best(limit: int) -> str:
    return f"{_RANKED} QUALIFY rank <= {limit}"


# Statistics by source, with every seventh document unreadable.
_FAILURES = f"""{_FILES},
marked AS (SELECT *, doc_id % 7 = 3 AS broken FROM files),
counted AS (
  SELECT source, count(*) AS discovered, count(*) FILTER (NOT broken) AS indexed,
         count(*) FILTER (broken) AS failed, CAST(0 AS BIGINT) AS skipped
  FROM marked GROUP BY source
),
worded AS (
  SELECT source, count(DISTINCT word) AS unique_words, count(*) AS total_tokens
  FROM (SELECT source, lower(unnest({_TOKENS.format('text')})) AS word FROM marked WHERE NOT broken)
  GROUP BY source
)"""


def oracle_sql() -> dict[str, str]:
    return {
        **_training_data()[1],
        "scan_supported_ext": f"WITH {_SCANNED} SELECT path FROM files WHERE {_SUPPORTED}",
        "scan_size_cap": f"""WITH {_SCANNED}
            SELECT path, size_bytes FROM files WHERE size_bytes <= 7000""",
        "scan_classify": f"WITH {_SCANNED} SELECT path, size_bytes, status FROM classified",
        "scan_status_counts": f"""WITH {_SCANNED}
            SELECT status, count(*) AS files FROM classified GROUP BY status""",
        "scan_order": f"""WITH {_SCANNED}
            SELECT row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS position, path
            FROM files""",
        "file_extension": rf"""WITH {_SCANNED}
            SELECT path, lower(regexp_extract(path, '[^/](\.[^./]*)$', 1)) AS extension
            FROM files""",
        "tokenize_rows": f"""WITH {_FILES},
            lists AS (SELECT path, {_TOKENS.format('text')} AS found FROM files)
            SELECT path, unnest(range(len(found))) AS position, lower(unnest(found)) AS word
            FROM lists""",
        "token_array_size": f"""WITH {_FILES}
            SELECT path, CAST(len({_TOKENS.format('text')}) AS BIGINT) AS token_count
            FROM files""",
        "file_token_counts": f"""WITH {_FILES}
            SELECT path, CAST(len({_TOKENS.format('text')}) AS BIGINT) AS token_count
            FROM files""",
        "token_count_by_line": f"""WITH {_FILES},
            lines AS (SELECT path, unnest(string_split(text, chr(10))) AS line FROM files)
            SELECT path, CAST(sum(len({_TOKENS.format('line')})) AS BIGINT) AS token_count
            FROM lines GROUP BY path""",
        "page_tokens": f"""SELECT page_id,
            CAST(len({_TOKENS.format('html')}) AS BIGINT) AS token_count FROM pages""",
        "postings": f"WITH {_INDEX} SELECT word, path, frequency FROM postings",
        "inverted_index": f"""WITH {_INDEX},
            sharded AS (
              SELECT *, CAST(('0x' || substr(md5(path), 1, 8)) AS BIGINT)
                % 256 AS shard
              FROM postings
            )
            SELECT word, shard,
                   string_agg(path || ':' || frequency, ',' ORDER BY path) AS postings
            FROM sharded GROUP BY word, shard""",
        "file_word_counts": f"""WITH {_INDEX}
            SELECT path, count(*) AS distinct_words,
                   CAST(sum(frequency) AS BIGINT) AS token_count,
                   CAST(coalesce(sum(frequency) FILTER (word = 'the'), 0) AS BIGINT) AS the_count
            FROM postings GROUP BY path""",
        "index_stats": f"WITH {_STATS} SELECT * FROM stats",
        "index_stats_by_source": f"""WITH {_FILES},
            counted AS (
              SELECT source, count(*) AS discovered, count(*) AS indexed,
                     CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped
              FROM files GROUP BY source
            ),
            worded AS (
              SELECT source, count(DISTINCT word) AS unique_words, count(*) AS total_tokens
              FROM (SELECT source, lower(unnest({_TOKENS.format('text')})) AS word FROM files)
              GROUP BY source
            )
            SELECT source, discovered, indexed, failed, skipped,
                   coalesce(unique_words, 0) AS unique_words,
                   coalesce(total_tokens, 0) AS total_tokens
            FROM counted LEFT JOIN worded USING (source)""",
        "stats_rendered": f"""WITH {_STATS}
            SELECT 'Discovered files' AS label, discovered AS value FROM stats
            UNION ALL SELECT 'Indexed files', indexed FROM stats
            UNION ALL SELECT 'Failed files', failed FROM stats
            UNION ALL SELECT 'Skipped files', skipped FROM stats
            UNION ALL SELECT 'Unique words', unique_words FROM stats
            UNION ALL SELECT 'Total tokens', total_tokens FROM stats""",
        "stats_with_failures": f"""WITH {_FAILURES}
            SELECT source, discovered, indexed, failed, skipped,
                   coalesce(unique_words, 0) AS unique_words,
                   coalesce(total_tokens, 0) AS total_tokens
            FROM counted LEFT JOIN worded USING (source)""",
        "failed_files": f"""WITH {_FILES}
            SELECT path, size_bytes, 'unreadable' AS error FROM files WHERE doc_id % 7 = 3""",
        "stats_differ": f"""WITH {_STATS},
            less AS (
              SELECT count(*) AS files FROM files WHERE source <> 'src1'
            ),
            words AS (
              SELECT count(DISTINCT word) AS unique_words, count(*) AS total_tokens
              FROM (SELECT lower(unnest({_TOKENS.format('text')})) AS word
                    FROM files WHERE source <> 'src1')
            )
            SELECT run_id, stats.*, TRUE AS equivalent
            FROM stats, (VALUES ('direct'), ('ledger'), ('by_line')) AS runs(run_id)
            UNION ALL
            SELECT 'changed', files, files, 0, 0, unique_words, total_tokens, FALSE
            FROM less, words""",
        "postings_differ": f"""WITH {_INDEX},
            changed AS (
              SELECT word, path, frequency + CASE WHEN word = 'und' THEN 1 ELSE 0 END AS frequency
              FROM postings WHERE word <> 'the'
            )
            SELECT *, CAST(1 AS BIGINT) AS balance FROM (FROM postings EXCEPT FROM changed)
            UNION ALL
            SELECT *, CAST(-1 AS BIGINT) FROM (FROM changed EXCEPT FROM postings)""",
        "stats_equivalence": f"""WITH {_STATS}
            SELECT run_id, stats.*, TRUE AS equivalent
            FROM stats, (VALUES ('direct'), ('ledger'), ('by_line')) AS runs(run_id)""",
        "postings_equivalence": f"""WITH {_INDEX}
            SELECT word, path, frequency, CAST(0 AS BIGINT) AS balance
            FROM postings WHERE frequency < 0""",
        "file_log_rows": f"""WITH {_FILES}
            SELECT path, size_bytes,
                   CAST(len({_TOKENS.format('text')}) AS BIGINT) AS token_count
            FROM files""",
        "tree_inventory": f"WITH {_SCANNED} SELECT path, size_bytes, status FROM classified",
        "store_inventory": f"WITH {_SCANNED} SELECT path, size_bytes, status FROM classified",
        "tree_postings": f"WITH {_INDEX} SELECT word, path, frequency FROM postings",
        "store_postings": f"WITH {_INDEX} SELECT word, path, frequency FROM postings",
        "postings_in_pieces": f"WITH {_INDEX} SELECT word, path, frequency FROM postings",
        "store_lost_files": f"""WITH {_FILES},
            words AS (
              SELECT count(DISTINCT word) AS unique_words, count(*) AS total_tokens
              FROM (SELECT lower(unnest({_TOKENS.format('text')})) AS word FROM files WHERE doc_id % 7 <> 3)
            )
            SELECT count(*) AS discovered, count(*) FILTER (doc_id % 7 <> 3) AS indexed,
                   count(*) FILTER (doc_id % 7 = 3) AS failed, CAST(0 AS BIGINT) AS skipped,
                   any_value(unique_words) AS unique_words, any_value(total_tokens) AS total_tokens
            FROM files, words""",
        "query_trim": f"""WITH {_ARGUMENTS}
            SELECT doc_id, trim(argument, {_SPACE}) AS trimmed FROM arguments""",
        "query_unquote": f"""WITH {_ARGUMENTS},
            trimmed AS (SELECT doc_id, trim(argument, {_SPACE}) AS t FROM arguments)
            SELECT doc_id,
              CASE WHEN length(t) >= 2 AND t[1] = t[-1] AND t[1] IN ('"', '''')
                   THEN substr(t, 2, length(t) - 2) ELSE t END AS unquoted
            FROM trimmed""",
        "query_terms": f"WITH {_TERMS} SELECT query_id, word FROM terms",
        "postings_lookup": f"WITH {_INDEX} SELECT * FROM postings WHERE word = 'the'",
        "postings_lookup_missing": f"WITH {_INDEX} SELECT * FROM postings WHERE word = 'zzzz'",
        "search_all": _search_sql(catalog.QUERY),
        "search_single_term": _search_sql(catalog.SINGLE),
        "search_multi_term": _search_sql(catalog.MULTI),
        "search_no_match": _search_sql("zzzz qqqqq"),
        "search_top20": f"""WITH {_INDEX},{_search(catalog.QUERY)}
            SELECT * FROM hits ORDER BY score DESC, path LIMIT 20""",
        "search_rendered": f"""WITH {_INDEX},{_search(catalog.QUERY)}
            SELECT path || ' | score=' || score || ' | matched_terms=' || matched_terms AS line
            FROM hits""",
        "search_scan": _search_sql(catalog.QUERY),
        "search_scan_top20": f"""WITH {_INDEX},{_search(catalog.QUERY)}
            SELECT * FROM hits ORDER BY score DESC, path LIMIT 20""",
        "search_batch": _RANKED,
        "search_batch_top10": _best(10),
        "session_search": _search_sql(catalog.QUERY),
        "session_lookup": f"WITH {_INDEX} SELECT * FROM postings WHERE word = 'the'",
        "session_batch_top10": _best(10),
        "session_best20": f"""WITH {_INDEX},{_search(catalog.QUERY)}
            SELECT * FROM hits ORDER BY score DESC, path LIMIT 20""",
        "block_postings": f"WITH {_INDEX} SELECT word, path, frequency FROM postings",
        "session_reopened": _search_sql(catalog.QUERY),
        "session_stats": f"WITH {_STATS} SELECT * FROM stats",
        "session_log": f"""WITH {_FILES}
            SELECT path, size_bytes,
                   CAST(len({_TOKENS.format('text')}) AS BIGINT) AS token_count
            FROM files""",
        "session_search_many_terms": _search_sql(catalog.MANY),
        "session_rebuild": f"""WITH {_FILES},{_postings("files WHERE source = 'src1'")}
            SELECT word, CAST(sum(frequency) AS BIGINT) AS frequency FROM postings GROUP BY word""",
        "session_clear": f"""WITH {_STATS}
            SELECT 'before' AS state, * FROM stats
            UNION ALL SELECT 'after', 0, 0, 0, 0, 0, 0""",
    }
