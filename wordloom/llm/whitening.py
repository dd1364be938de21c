"""Whitening of embeddings by shifted Cholesky QR.

The distinct vectors, centred, are the rows of a tall matrix A. A pass over it
adds up a small Gram matrix; a Cholesky factor of that matrix makes the columns
of A more nearly orthogonal by a triangular solve, without moving a row. The
first pass shifts the diagonal, so that its factor exists however badly A is
conditioned; further passes bring the columns to orthogonality in working
precision. The product R of all factors has the singular values and right
singular vectors of A, which are the whitening components. The covariance
itself, whose condition is the square of A's, is never decomposed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept
from wordloom.llm.vectors import finite, matrix

#: Gram passes at most. Three do for any matrix of full rank; the fourth leaves
#: room for one that is not, whose factors keep being shifted.
PASSES = 4
#: Distance of a Gram matrix from the identity at which its columns count as orthogonal.
ORTHOGONAL = 1e-13
#: Largest shift of the first pass, as a part of the norm of the Gram matrix.
MOST_SHIFT = 1e-8
#: Part of the largest singular value below which one counts as zero.
NO_SPREAD = 1e-13
#: Rows that are worked on at once inside a task.
_ROWS = 8192
#: Bits of the low part in which whole numbers are added up.
_LOW = 32

_UNIT = float(np.finfo(float).eps) / 2


@dataclass
class Whitening:
    """A fitted transformation: ``components`` holds unit vectors as rows, largest spread first."""

    size: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    components: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    eigenvalues: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trace: float = 0.0
    passes: int = 0
    identity_error: float | None = None

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean in two parts, whole numbers and what is left of them."""
        parts = [divmod(total, self.n) for total in self.sums]
        return np.array([q for q, _ in parts], np.int64), np.array([r / self.n for _, r in parts], np.float64)

    def projection(self, most: int) -> np.ndarray:
        """What takes a centred row to its first whitened coordinates."""
        best = self.components[:most] / np.sqrt(self.eigenvalues[:most])[:, None]
        return best.T


def levels(vector: Column, scale: int) -> Column:
    """floor(scale * c) of every component as a whole number.

    Not defined, that is null, where a component is not a finite number or its
    level does not fit a long; this also holds for null and empty vectors.
    """
    scaled = F.transform(vector, lambda c: F.lit(float(scale)) * c.cast("double"))
    fits = finite(vector) & F.forall(scaled, lambda c: F.abs(c) < float(1 << 62))
    return F.when(fits, F.transform(scaled, lambda c: F.floor(c).cast("bigint")))


def leveled(table: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """Rows (vec_id, x) that take part, and their dimension.

    Left out are vectors without levels, and those of another length than the
    most common one (the shorter one, if two are equally common). Rows without
    an id and rows that repeat one take part like any other.
    """
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), levels(F.col(embedding), scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), "size").first()
    size = best["size"] if best else 0
    return rows.where(F.size("x") == size), size


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            part = batch.slice(first, _ROWS)
            yield part, matrix(part.column(at))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums per dimension of one task, the sums in two parts that cannot overflow."""
    n, high, low = 0, None, None
    for _, x in _blocks(batches, 0):
        if high is None:
            high, low = np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)
        n += len(x)
        high += (x >> _LOW).sum(axis=0)
        low += (x & ((1 << _LOW) - 1)).sum(axis=0)
    if n:
        size = len(high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(high), pa.array(low)],
            ["place", "n", "high", "low"],
        )


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Rows less the mean, rounded once: the whole part is taken off as whole numbers."""
    return (x - whole).astype(np.float64) - rest


def _gram(whole: np.ndarray, rest: np.ndarray, factors: list[np.ndarray], projection: np.ndarray | None = None):
    """Q'Q and the column sums of Q for the rows of one task.

    The rows of Q are those of A after a solve with each triangular factor in
    turn, or their projection.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, 0):
            q = _centred(x, whole, rest)
            for factor in factors:
                q = np.linalg.solve(factor.T, q.T).T
            if projection is not None:
                q = q @ projection
            if total is None:
                total = np.zeros((q.shape[1] + 1, q.shape[1]))
            total[:-1] += q.T @ q
            total[-1] += q.sum(axis=0)
        if total is not None:
            rows, columns = np.indices(total.shape, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.ravel()), pa.array(columns.ravel()), pa.array(total.ravel())], ["i", "j", "part"]
            )

    return run


def _added(fit_list: DataFrame, run: Callable, size: int) -> np.ndarray:
    """The matrices of all tasks added up: at most size * (size + 1) numbers reach the driver."""
    parts = fit_list.select("x").mapInArrow(run, "i int, j int, part double")
    total = np.zeros((size + 1, size))
    for row in parts.groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        total[row["i"], row["j"]] = row["total"]
    return total


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix, shifted further until there is one."""
    step = np.eye(len(gram))
    for _ in range(60):
        try:
            return np.linalg.cholesky(gram + shift * step).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, 11 * len(gram) * _UNIT * max(np.trace(gram), np.finfo(float).tiny))
    raise ValueError("the Gram matrix is not that of finite rows")


def _root(gram: np.ndarray) -> np.ndarray:
    """The symmetric square root, which a singular Gram matrix has as well."""
    values, vectors = np.linalg.eigh(gram)
    return (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T


def fit(rows: DataFrame, size: int, most: int) -> Whitening:
    """Fit on every distinct ``x`` of ``rows`` once; no row is sampled.

    ``size`` numbers per row and pass are read, ``size`` squared numbers per task
    are shuffled and as many reach the driver. Dimensions without any spread
    have no component. No rows at all give a model without components.
    """
    model = Whitening(size)
    fit_list = kept(rows.select("x").distinct())
    totals = fit_list.mapInArrow(_totals, "place int, n bigint, high bigint, low bigint")
    wide = "decimal(38,0)"
    for row in (
        totals.groupBy("place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
        .orderBy("place")
        .collect()
    ):
        model.n = row["n"]
        model.sums.append((int(row["high"]) << _LOW) + int(row["low"]))
    if model.n < 2:
        return model
    whole, rest = model.centre()

    factors: list[np.ndarray] = []
    while True:
        gram = _added(fit_list, _gram(whole, rest, factors), size)[:-1]
        model.passes += 1
        orthogonal = factors and np.abs(gram - np.eye(size)).max() < ORTHOGONAL
        if orthogonal or model.passes == PASSES or not gram.any():
            break
        # At most the shift that keeps the first factor well defined; never one as large as the matrix.
        shift = min(11 * (model.n * size + size * (size + 1)) * _UNIT, MOST_SHIFT) * np.linalg.norm(gram, 2)
        factors.append(_factor(gram, 0.0 if factors else shift))
    # A = Q R with R the product of the factors. What the last Gram matrix still
    # says about the columns of Q is the last factor.
    product = _root(gram)
    for factor in reversed(factors):
        product = product @ factor
    _, spread, components = np.linalg.svd(product)
    with_spread = spread > NO_SPREAD * spread[0] if spread[0] > 0 else np.zeros(size, bool)
    model.trace = float(math.fsum((spread**2).tolist()) / model.n)
    model.components, model.eigenvalues = components[with_spread], spread[with_spread] ** 2 / model.n
    used = len(model.eigenvalues[:most])
    if used:
        found = _added(fit_list, _gram(whole, rest, [], model.projection(most)), size)
        mean = found[-1, :used] / model.n
        covariance = found[:used, :used] / model.n - np.outer(mean, mean)
        model.identity_error = float(np.abs(covariance - np.eye(used)).max())
    return model


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S) squared per row, exact; null where it passes the range of a long."""
    if not len(x):
        return []
    most = max(abs(n * v - s) for s, low, high in zip(sums, x.min(axis=0).tolist(), x.max(axis=0).tolist()) for v in (low, high))
    if most * most * len(sums) < 1 << 63 and n * int(np.abs(x).max()) < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        apart = x * np.int64(n) - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [one if one < 1 << 63 else None for one in exact]


def _whitener(model: Whitening, most: int):
    whole, rest = model.centre()
    projection = model.projection(most)
    count = projection.shape[1]
    explained = model.eigenvalues[:count] / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1):
            coordinates = _centred(x, whole, rest) @ projection
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n)),
                    pa.array([one for one in _deviations(x, model.n, model.sums) for _ in range(count)], pa.int64()),
                    pa.array(coordinates.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


_ROW = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(
    table: DataFrame, most: int = 4, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Whitened coordinates of every valid vector, a row per vector and component.

    Columns: (vec_id, component, n, deviation, whitened, explained, identity_error).
    Components are numbered from 1 by falling eigenvalue. Components without any
    spread have no coordinates and no rows, so a table of fewer than two distinct
    vectors, or an empty one, gives no rows. ``deviation`` is null where it does
    not fit a long. Null, empty and non-finite vectors, those whose levels do not
    fit a long and those of an uncommon length take no part; repeated rows keep
    a row each, null ids stay null. Other columns are never looked at.
    """
    rows, size = leveled(table, scale, vec_id, embedding)
    model = fit(rows, size, most)
    if not len(model.eigenvalues):
        return table.sparkSession.createDataFrame([], _ROW)
    return rows.select("vec_id", "x").mapInArrow(_whitener(model, most), _ROW)
