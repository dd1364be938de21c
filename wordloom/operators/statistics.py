"""Index statistics, their rendering, and the comparison of builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import fold, raw_tokens
from wordloom.operators.classify import FAILED, INDEXED, SKIPPED, outcome_of
from wordloom.schemas import STAT_COLUMNS

# The label of each statistic.
STAT_LABELS = {
    "discovered": "Discovered files",
    "indexed": "Indexed files",
    "failed": "Failed files",
    "skipped": "Skipped files",
    "unique_words": "Unique words",
    "total_tokens": "Total tokens",
}


def index_stats(
    corpus: DataFrame, by: Sequence[str] = (), words: Column | None = None
) -> DataFrame:
    """The six counts, from one pass over the text and one wide shuffle.

    Every file emits its tokens and, from its first piece, one closing null.
    After counting by word, which the map side does first, a null row says how
    many files had an outcome and any other row says how often a word occurs.
    ``by`` adds grouping columns; a group holding most of the files is still
    spread over its words. ``words`` replaces the token array.
    """
    found = F.when(outcome_of() == INDEXED, raw_tokens("text") if words is None else words)
    marks = corpus.select(
        *by,
        outcome_of().alias("outcome"),
        F.explode(
            F.concat(
                F.coalesce(found, F.array().cast("array<string>")),
                F.when(F.col("piece") == 0, F.array(F.lit(None).cast("string"))).otherwise(
                    F.array().cast("array<string>")
                ),
            )
        ).alias("token"),
    )
    by_word = (
        marks.select(*by, "outcome", fold("token").alias("word"))
        .groupBy(*by, "outcome", "word")
        .agg(F.count("*").alias("n"))
    )
    return _six_counts(by_word, by)


def ledger_stats(entries: DataFrame) -> DataFrame:
    """The six counts of a build, from its ledger and without its texts."""
    by_word = entries.groupBy("outcome", "word").agg(F.sum("frequency").alias("n"))
    return _six_counts(by_word)


# The sum of a set of postings: what it folds, in which order, does not matter.
PRINT_COLUMNS = ("postings", "frequencies", "one_print", "other_print")


def _prints() -> list[Column]:
    """Two independent 64-bit hashes of a posting."""
    posting = ("word", "path", "frequency")
    return [F.xxhash64(*posting).alias("one"), F.xxhash64(F.lit("other"), F.reverse("word"), *posting).alias("other")]


def fingerprint(index: DataFrame) -> DataFrame:
    """One row that stands for a set of postings, without a shuffle of any of them.

    Equal sets have equal rows. Sets that differ have equal ones with a chance of
    about 2^-128: exclusive or of two hashes, next to the number of postings and
    the sum of their frequencies.
    """
    hashed = index.select("frequency", *_prints())
    return hashed.agg(
        F.count("*").alias("postings"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("frequencies"),
        F.bit_xor("one").alias("one_print"),
        F.bit_xor("other").alias("other_print"),
    )


def ledger_summary(entries: DataFrame) -> DataFrame:
    """The six counts of a build and the fingerprint of its postings, in one pass."""
    is_posting = F.col("word").isNotNull()
    one, other = _prints()
    by_word = entries.groupBy("outcome", "word").agg(
        F.sum("frequency").alias("n"),
        F.count_if(is_posting).alias("postings"),
        F.bit_xor(F.when(is_posting, one)).alias("one_print"),
        F.bit_xor(F.when(is_posting, other)).alias("other_print"),
    )
    return _six_counts(
        by_word,
        (),
        F.coalesce(F.sum("postings"), F.lit(0)).alias("postings"),
        F.coalesce(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))), F.lit(0)).alias("frequencies"),
        F.bit_xor("one_print").alias("one_print"),
        F.bit_xor("other_print").alias("other_print"),
    )


def _six_counts(by_word: DataFrame, by: Sequence[str] = (), *more: Column) -> DataFrame:
    """Add up rows (outcome, word, n), where a null word stands for files."""
    is_file = F.col("word").isNull()

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    return by_word.groupBy(*by).agg(
        total(is_file, "discovered"),
        total(is_file & (F.col("outcome") == INDEXED), "indexed"),
        total(is_file & (F.col("outcome") == FAILED), "failed"),
        total(is_file & (F.col("outcome") == SKIPPED), "skipped"),
        F.count("word").alias("unique_words"),
        total(~is_file, "total_tokens"),
        *more,
    )


def rendered_stats(stats: DataFrame) -> DataFrame:
    """One (label, value) row per statistic."""
    return stats.select(
        F.stack(
            F.lit(len(STAT_LABELS)),
            *[
                column
                for name, label in STAT_LABELS.items()
                for column in (F.lit(label), F.col(name))
            ],
        ).alias("label", "value")
    )


def equivalence(runs: DataFrame, baseline_run: str) -> DataFrame:
    """Compare each run's six statistics with those of ``baseline_run``.

    ``runs`` holds one row per build, keyed by ``run_id``. Each build is computed
    once: the baseline is picked out of the same few rows.
    """
    of_baseline = F.max(
        F.when(F.col("run_id") == baseline_run, F.struct(*STAT_COLUMNS))
    ).over(Window.partitionBy())
    return runs.withColumn("baseline", of_baseline).select(
        "run_id",
        *STAT_COLUMNS,
        F.coalesce(F.struct(*STAT_COLUMNS) == F.col("baseline"), F.lit(False)).alias("equivalent"),
    )


def posting_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Postings found in one index only; empty when both are equal."""
    columns = ["word", "path", "frequency"]
    left, right = left.select(*columns), right.select(*columns)
    return (
        left.withColumn("side", F.lit(1))
        .unionByName(right.withColumn("side", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("side").alias("balance"))
        .where(F.col("balance") != 0)
    )


def differing_postings(left: DataFrame, right: DataFrame) -> DataFrame:
    """``posting_differences``, worked out only if the fingerprints disagree.

    Both indexes must hold a posting once, as every index does.
    """
    prints = fingerprint(left).unionAll(fingerprint(right)).collect()
    differences = posting_differences(left, right)
    return differences.limit(0) if prints[0] == prints[1] else differences
