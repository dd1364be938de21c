"""Append-only log of indexed files: Parquet batches and a manifest of those that count."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.classify import INDEXED
from wordloom.schemas import INDEXED_FILES
from wordloom.sources.workspace import claim, entries_in, entry


def log_rows(files: DataFrame, indexed_at: Column | None = None) -> DataFrame:
    """Log rows of the indexed files among the stored file rows."""
    when = F.unix_timestamp() if indexed_at is None else indexed_at
    return files.where(F.col("outcome") == INDEXED).select(
        "path", "size_bytes", "token_count", when.cast("bigint").alias("indexed_at")
    )


def _manifest(location: str) -> str:
    # Spark leaves out names that begin like this when it reads a table.
    return f"{location}/_batches"


def create_log(spark: SparkSession, location: str) -> None:
    """Create an empty log unless there is one already."""
    if not entries_in(spark, _manifest(location)):
        _commit(spark.createDataFrame([], INDEXED_FILES), location)


def _commit(batch: DataFrame, location: str) -> None:
    """Write a batch to a folder of its own, then enter the folder in the manifest.

    The entry is one file that the storage creates in one step, so a batch is
    there as a whole or not at all, also on storage that cannot rename folders.
    Of writers that come at once each finds a number of its own.
    """
    spark = batch.sparkSession
    name = f"batch={uuid.uuid4().hex}"
    batch.write.parquet(f"{location}/{name}")
    number = max(entries_in(spark, _manifest(location)), default=0)
    while not claim(spark, _manifest(location), number := number + 1, {"batch": name}):
        pass


def append_log(rows: DataFrame, location: str) -> None:
    """Append a batch as a whole, or nothing if any value in it is null.

    An empty batch writes nothing. Rows of earlier batches stay as they are.
    """
    if rows.isEmpty():
        return
    checked = rows.select(
        *[
            F.coalesce(
                F.col(field.name).cast(field.dataType),
                F.raise_error(F.lit(f"{field.name} must not be null")).cast(field.dataType),
            ).alias(field.name)
            for field in INDEXED_FILES.fields
        ]
    )
    _commit(checked, location)


def read_log(spark: SparkSession, location: str) -> DataFrame:
    """All committed batches. What a failed writer left behind is in no batch."""
    told = (entry(spark, _manifest(location), number) for number in entries_in(spark, _manifest(location)))
    folders = [f"{location}/{one['batch']}" for one in told if one is not None]
    if not folders:
        return spark.createDataFrame([], INDEXED_FILES)
    return spark.read.schema(INDEXED_FILES).parquet(*folders)
