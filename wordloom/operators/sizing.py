"""Size checks that decide on a broadcast."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest table that is broadcast, counted as payload bytes.
BROADCAST_BYTES = 32 * 1024 * 1024

#: Input bytes one core is expected to work through in one task.
TASK_BYTES = 128 * 1024 * 1024

#: Text whose postings one task counts. Postings, as rows of a hash table, take
#: tens of times the bytes of their text.
COUNTED_BYTES = 8 * 1024 * 1024

#: Postings that one task regroups.
GROUPED_ROWS = 500_000

#: Least share of text or postings that is worth a task of its own.
_LEAST_SHARE = 8

#: Fixed cost charged for every row of a broadcast table.
ROW_OVERHEAD = 32


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one aggregate job and compare it with ``max_bytes``."""
    width = F.lit(ROW_OVERHEAD).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            width = width + 8
    total = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    return total <= max_bytes


def tasks_for(df: DataFrame, measure: Column | str, per_task: int) -> int:
    """Tasks that get about ``per_task`` of a measure that is summed over ``df``, in one job.

    Their number grows with the input, so a task does not. Of a small input a
    task gets less, until there is one for each core.
    """
    total = df.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("total")).first()["total"]
    return _tasks_of(df, total, per_task)


def _tasks_of(df: DataFrame, total: int, per_task: int) -> int:
    least = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total * _LEAST_SHARE / per_task))
    return max(1, least, math.ceil(total / per_task))


def _text_size(text: str) -> Column:
    return F.octet_length(F.col(text)).cast("bigint") + ROW_OVERHEAD


def text_parts(documents: DataFrame, text: str = "text") -> int:
    """Parts of about ``COUNTED_BYTES`` that the texts of a table make."""
    return tasks_for(documents, _text_size(text), COUNTED_BYTES)


def text_parts_and(documents: DataFrame, special: Column, text: str = "text") -> tuple[int, bool]:
    """The same parts, and whether any row is special, from one job."""
    total = F.coalesce(F.sum(_text_size(text)), F.lit(0)).alias("total")
    told = documents.agg(total, F.coalesce(F.bool_or(special), F.lit(False)).alias("special")).first()
    return _tasks_of(documents, told["total"], COUNTED_BYTES), told["special"]


def dealt_texts(corpus: DataFrame, documents: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """A corpus dealt by path in parts of about ``COUNTED_BYTES`` of the texts of ``documents``.

    The rows of a file stay together, so words are counted by (word, path) after
    this without another shuffle.
    """
    return corpus.repartition(text_parts(documents, text), path)
