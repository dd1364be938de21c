"""Ranges of (word, path) that an index is cut into, told by a sample of its texts.

Spark cuts ranges by a sample of the rows themselves, for which it computes them
all, tokens and counts included, and then once more to shuffle them. The texts of a
large index are thus sampled before anything is counted. A sample moves the cuts
and no row: every row goes to the one range that holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import fold, raw_tokens
from wordloom.operators.classify import INDEXED, outcome_of
from wordloom.operators.sizing import COUNTED_BYTES

#: Text behind one range, as parts of ``COUNTED_BYTES``: its rows are sorted in one task.
PARTS_PER_RANGE = 2

#: Bytes of the pieces that are sampled, and pieces that are sampled at least, about.
SAMPLED_PIECE, SAMPLED_PIECES = 64 * 1024, 64

#: Bytes of text that are sampled, and keys that reach the driver, per range, about.
SAMPLED_BYTES, SAMPLED_KEYS = 8 * 1024, 64

# Text that gives about one posting.
_POSTING_BYTES = 12

_SHARES = 1 << 30


def _key() -> Column:
    """The order of (word, path) as one string; rows of files, which have no word, come first."""
    return F.concat(F.coalesce("word", F.lit("")), F.lit("\0"), F.coalesce("path", F.lit("")))


def _share(drawn: Column, wanted: float) -> Column:
    return F.pmod(drawn, F.lit(_SHARES)) < int(min(1.0, wanted) * _SHARES)


def sampled_bounds(pieces: DataFrame, parts: int) -> list[str]:
    """Keys that cut a corpus of ``parts`` parts into ranges of about the same number of rows.

    ``pieces`` is the corpus in pieces of ``SAMPLED_PIECE`` bytes at most. Which are
    sampled follows from path and number, so only these are cut and read for tokens.
    """
    ranges = max(2, parts // PARTS_PER_RANGE)
    total = parts * COUNTED_BYTES
    sampled = min(total, max(ranges * SAMPLED_BYTES, SAMPLED_PIECES * SAMPLED_PIECE))
    some = pieces.where(_share(F.xxhash64("path", "piece"), sampled / total))
    found = F.coalesce(F.when(outcome_of() == INDEXED, raw_tokens("text")), F.array().cast("array<string>"))
    token = F.explode(F.concat(found, F.array(F.lit(None).cast("string")))).alias("token")
    keys = some.select("path", token).select(fold("token").alias("word"), "path").select(_key().alias("key"))
    kept = keys.where(_share(F.xxhash64(F.lit("kept"), "key"), ranges * SAMPLED_KEYS * _POSTING_BYTES / sampled))
    told = sorted(row["key"] for row in kept.distinct().collect())
    return sorted({told[at * len(told) // ranges] for at in range(1, ranges)}) if told else []


def ranged(entries: DataFrame, bounds: list[str]) -> DataFrame:
    """Rows with the number of their range, which is how many bounds do not come after a row.

    It is found by halving, a step per projection.
    """
    if not bounds:
        return entries.withColumn("range", F.lit(0))
    held, at = F.lit(bounds), F.col("range")
    dealt = entries.withColumn("key", _key()).withColumn("range", F.lit(0))
    step = 1 << (len(bounds).bit_length() - 1)
    while step:
        further = F.get(held, at + (step - 1)) <= F.col("key")
        dealt = dealt.withColumn("range", F.when(further, at + step).otherwise(at))
        step //= 2
    return dealt.drop("key")


def in_ranges(entries: DataFrame, bounds: list[str]) -> DataFrame:
    """Rows dealt to the ranges between the bounds, a partition each; ``range`` is used if it is there."""
    dealt = entries if "range" in entries.columns else ranged(entries, bounds)
    return dealt.repartitionById(len(bounds) + 1, "range").drop("range")
