"""What both vector searches need: valid vectors, copies as one row, work in cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = F.transform(vector, lambda v: v.cast("double"))
    return F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)
    ) & (F.size(vector) > 0)


def valid_vectors(table: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """Rows (vec_id, vector) that take part, and their dimension.

    Left out are rows without an id, null vectors, vectors with null or
    non-finite components, and vectors of another length than the most common
    one (the shorter one, if two are equally common).
    """
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), "size").first()
    size = best["size"] if best else 0
    return rows.where(F.size("vector") == size), size


def without_copies(rows: DataFrame, most: int) -> DataFrame:
    """Each distinct vector once, with its ``most`` smallest ids in order.

    A search for ``most`` - 1 nearest rows never needs another copy, since ties
    go to smaller ids. Copies are cut down before they are shuffled. Rows that
    repeat an id and a vector are one row.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.withColumn("copy", F.dense_rank().over(order)).where(F.col("copy") <= most)
    return kept(first.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))


def query_rows(rows: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``; of several with one id the least vector."""
    return rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[list[int]], np.ndarray]]:
    """Stretches of rows of one cell and role: (cell, role, ids, vectors)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column(0).to_numpy()
        roles = batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(roles) != 0)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
            part = batch.slice(start, stop - start)
            yield int(cells[start]), int(roles[start]), part.column(2).to_pylist(), matrix(part.column(3))


def expanded(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and which vector each belongs to."""
    counts = [len(one) for one in ids]
    return np.array([i for one in ids for i in one], np.int64), np.repeat(np.arange(len(ids)), counts)


def best_rows(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    """The first ``k`` rows per query by score, ties to smaller ids, with their rank."""
    score = F.asc("score") if ascending else F.desc("score")
    order = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
