"""Intermediate tables, kept where every executor and the driver can read them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.workspace import new_location

#: Most rows of a lookup table that is sent to every executor. The tables it is
#: used for hold one short row per source, language or sequence pattern.
LOOKUP_ROWS = 50_000


def kept(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to ``spark.checkpoint.dir`` and go on from there.

    The files outlive their executors, and Spark removes them once nothing uses
    the result any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_location(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def lookup(df: DataFrame, most: int = LOOKUP_ROWS) -> DataFrame:
    """Mark a kept table for broadcast if it has at most ``most`` rows.

    Beyond that it is joined by shuffle, with the same result.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


_resident: tuple[Hashable, Any] | None = None


def resident(key: Hashable, make: Callable[[], Any]) -> Any:
    """The one large object that a worker keeps from task to task.

    Workers live as long as their executor. A model or vocabulary gives way to
    that of the next operator, so that they do not add up.
    """
    global _resident
    if _resident is None or _resident[0] != key:
        release()
        _resident = (key, make())
        _trim()
    return _resident[1]


def release() -> None:
    """Let go of it, in tasks that need their memory for themselves."""
    global _resident
    _resident = None
    _trim()


def _trim() -> None:
    """Give freed memory back to the system where its allocator can be told to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for files an operator writes."""
    return new_location(spark, label)
