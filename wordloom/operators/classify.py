"""Which discovered entries are indexed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import is_supported, path_components
from wordloom.sources.workspace import new_location

#: Fixed value: largest file, inclusive, under the size rule (5 MiB). The rule is
#: off unless it is asked for with ``max_bytes``.
MAX_FILE_BYTES = 5 * 1024 * 1024

ELIGIBLE = "eligible"
SKIPPED = "skipped"
INACCESSIBLE = "inaccessible"

INDEXED = "indexed"
FAILED = "failed"


def status_of(
    path: Column | str, size_bytes: Column | str, max_bytes: int | None = None
) -> Column:
    """Eligible, skipped, or inaccessible when no size could be read."""
    size = F.col(size_bytes) if isinstance(size_bytes, str) else size_bytes
    small = F.lit(True) if max_bytes is None else size <= max_bytes
    return (
        F.when(size.isNull(), F.lit(INACCESSIBLE))
        .when(is_supported(path) & small, F.lit(ELIGIBLE))
        .otherwise(F.lit(SKIPPED))
    )


def outcome_of() -> Column:
    """What became of a corpus row: indexed, failed or skipped.

    Inaccessible entries count as skipped, so that
    discovered = indexed + failed + skipped.
    """
    return (
        F.when(F.col("status") != ELIGIBLE, F.lit(SKIPPED))
        .when(F.col("error").isNotNull(), F.lit(FAILED))
        .otherwise(F.lit(INDEXED))
    )


def readable(corpus: DataFrame) -> DataFrame:
    """The rows whose text is indexed."""
    return corpus.where((F.col("status") == ELIGIBLE) & F.col("error").isNull())


def failures(corpus: DataFrame) -> DataFrame:
    """Eligible files that could not be read, with the reason."""
    return corpus.where(
        (F.col("status") == ELIGIBLE) & F.col("error").isNotNull()
    ).select("path", "size_bytes", "error")


def status_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("status").agg(F.count("*").alias("files"))


def in_scan_order(corpus: DataFrame, workspace: str | None = None) -> DataFrame:
    """Every path with its position in a directory scan, from 0: (position, path).

    A scan goes by path components, which differs from plain string order.
    Paths are cut into ranges and sorted inside them; the row counts of the
    ranges give the offset of each. The sorted rows are stored first, so that
    counts and rows come from the same ranges.
    """
    spark = corpus.sparkSession
    location = new_location(spark, "order", workspace)
    parts = path_components("path")
    row = F.monotonically_increasing_id()
    (
        corpus.select("path")
        .repartitionByRange(parts)
        .sortWithinPartitions(parts)
        .select("path", F.shiftright(row, 33).alias("range"), row.bitwiseAND((1 << 33) - 1).alias("place"))
        .write.parquet(location)
    )
    stored = spark.read.schema("path string, range bigint, place bigint").parquet(location)
    before = F.sum("rows").over(Window.orderBy("range")) - F.col("rows")
    offsets = (
        stored.groupBy("range").agg(F.count("*").alias("rows")).select("range", before.alias("before"))
    )
    return stored.join(offsets, "range").select(
        (F.col("before") + F.col("place")).alias("position"), "path"
    )
