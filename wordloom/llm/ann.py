"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are turned by a random rotation and dealt to the list of their nearest
centroid. A list is searched in blocks that hold the rotated vectors column by
column. For each query the squared distances grow a few columns at a time; after
each step a test asks whether a vector this far off in some of the random
directions can still be among the nearest, and the others are given up.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, lookup, resident, shared_folder
from wordloom.llm.token_files import store, write_whole
from wordloom.llm.vectors import best_rows, expanded, matrix, query_rows, segments, valid_vectors, without_copies

#: Most vectors the centroids are fitted on, and most of them kept as a first answer.
FIT_ROWS, ANCHOR_ROWS = 20_000, 2_000
#: Vectors of a list on average, and most lists.
LIST_ROWS, MOST_LISTS = 1_000, 4_096
#: Part of the nearest neighbours that the probed lists should hold, and the
#: sampled queries on which the number of probes is set.
PROBE_RECALL, PROBE_QUERIES = 0.98, 256
#: Vectors of a list that are searched in one go, and queries that share a search.
BLOCK_ROWS, GROUP_QUERIES = 4_096, 4_096
#: Columns between two tests, and how many standard deviations a test allows.
STEP, TOLERANCE = 16, 2.6

_LISTED = "list bigint, ids array<bigint>, vector array<double>"
_FOUND = "query_id bigint, vec_id bigint, score double"


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def centroids(rows: np.ndarray, count: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Plain k-means."""
    count = min(count, len(rows))
    centers = rows[np.random.default_rng(seed).choice(len(rows), count, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(rows, centers, 1)[:, 0]
        sums = np.zeros_like(centers)
        np.add.at(sums, near, rows)
        sizes = np.bincount(near, minlength=count)
        centers[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centers


def _nearest(rows: np.ndarray, centers: np.ndarray, count: int) -> np.ndarray:
    """The places of the ``count`` nearest centers of each row, nearest first."""
    square = (centers**2).sum(axis=1)[None, :] - 2 * rows @ centers.T
    return np.argsort(square, axis=1, kind="stable")[:, :count]


def probes_for(rows: np.ndarray, centers: np.ndarray, k: int, recall: float = PROBE_RECALL) -> int:
    """Lists to probe so that they hold this part of the k nearest rows, measured on a sample."""
    lists = len(centers)
    home = _nearest(rows, centers, 1)[:, 0]
    queries = rows[:: max(1, len(rows) // PROBE_QUERIES)]
    square = (rows**2).sum(axis=1)[None, :] - 2 * queries @ rows.T
    near = np.argpartition(square, min(k, len(rows) - 1), axis=1)[:, : k + 1]
    order = _nearest(queries, centers, lists)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(lists), order.shape), axis=1)
    ranks = np.take_along_axis(place, home[near], axis=1)
    return int(np.quantile(ranks, recall)) + 1


class Index:
    """Rotation, centroids and anchors: everything that is fitted, bounded in size."""

    def __init__(self, turn: np.ndarray, centers: np.ndarray, anchors: np.ndarray, anchor_ids: list[list[int]]):
        self.turn, self.centers, self.anchors, self.anchor_ids = turn, centers, anchors, anchor_ids

    def dump(self) -> bytes:
        out = io.BytesIO()
        ids, owners = expanded(self.anchor_ids)
        np.savez(out, turn=self.turn, centers=self.centers, anchors=self.anchors, ids=ids, owners=owners)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Index:
        found = np.load(io.BytesIO(data))
        ids: list[list[int]] = [[] for _ in found["anchors"]]
        for owner, one in zip(found["owners"].tolist(), found["ids"].tolist()):
            ids[owner].append(one)
        return cls(found["turn"], found["centers"], found["anchors"], ids)


def _loaded(location: str) -> Index:
    def load() -> Index:
        files, path = store(location)
        with files.open_input_file(path) as file:
            return Index.load(file.read())

    return resident(("vectors", location), load)


def fit(distinct: DataFrame, size: int, k: int) -> tuple[Index, int]:
    """The index, and how many lists a query probes.

    Fitted on the ``FIT_ROWS`` vectors with the smallest digests, or all if there are fewer."""
    count = distinct.count()
    sample = distinct.orderBy(F.xxhash64("vector"), "ids").limit(FIT_ROWS).select("ids", "vector").collect()
    rows = np.array([row["vector"] for row in sample], np.float64).reshape(len(sample), size)
    turn = rotation(size)
    lists = max(1, min(MOST_LISTS, math.ceil(count / LIST_ROWS), len(sample)))
    centers = centroids(rows @ turn, lists)
    index = Index(turn, centers, rows[:ANCHOR_ROWS], [row["ids"] for row in sample[:ANCHOR_ROWS]])
    return index, probes_for(rows @ turn, centers, k)


def _assigner(location: str):
    """The list of each vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(location)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows = matrix(part.column(1)).astype(np.float64)
                near = _nearest(rows @ index.turn, index.centers, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near, pa.int64()), part.column(0), pa.array(list(rows), pa.list_(pa.float64()))],
                    ["list", "ids", "vector"],
                )

    return assign


def _prober(location: str, probes: int):
    """Each query once per list it probes, its squared bound as a last component."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(location)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = matrix(part.column(2)).astype(np.float64)
                near = _nearest(rows @ index.turn, index.centers, probes)
                bound = part.column(1).to_numpy(zero_copy_only=False) ** 2
                again = np.repeat(np.arange(len(rows)), near.shape[1])
                bounded = np.column_stack([rows, bound])[again]
                ids = part.column(0).to_numpy()[again]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(near.ravel(), pa.int64()),
                        pa.array(list(ids[:, None]), pa.list_(pa.int64())),
                        pa.array(list(bounded), pa.list_(pa.float64())),
                    ],
                    ["list", "ids", "vector"],
                )

    return probe


def scan_block(
    columns: np.ndarray, query: np.ndarray, bound: float, step: int = STEP, tolerance: float = TOLERANCE
) -> np.ndarray:
    """Places in a block of rotated columns that may be as near as ``bound`` (squared).

    After d of D columns a vector is given up if its partial distance is above
    bound * d / D * (1 + tolerance / sqrt(d)) ** 2.
    """
    size, count = columns.shape
    alive = np.arange(count)
    partial = np.zeros(count)
    for done in range(0, size, step):
        stop = min(size, done + step)
        part = columns[done:stop] if len(alive) == count else columns[done:stop, alive]
        partial += ((part - query[done:stop, None]) ** 2).sum(axis=0)
        allowed = bound * (1 + 1e-9) if stop == size else bound * stop / size * (1 + tolerance / math.sqrt(stop)) ** 2
        good = partial <= allowed
        if not good.all():
            alive, partial = alive[good], partial[good]
    return alive


def _searcher(location: str, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(location)
        cell, ids, rows, block = None, [], [], None
        for this, role, their_ids, vectors in segments(batches):
            if this != cell:
                cell, ids, rows, block = this, [], [], None
            if role == 0:
                ids += their_ids
                rows.append(vectors)
                continue
            if not rows:
                continue
            if block is None:
                whole = np.concatenate(rows)
                block = np.ascontiguousarray((whole @ index.turn).T)
                all_ids, owners = expanded(ids)
                starts = np.concatenate([[0], np.cumsum([len(one) for one in ids])])
            out: list[list] = [[], [], []]
            for own, vector in zip(their_ids, vectors):
                query_id, bound = own[0], vector[-1]
                query = vector[:-1]
                places = scan_block(block, query @ index.turn, bound)
                if not len(places):
                    continue
                exact = np.sqrt(((whole[places] - query) ** 2).sum(axis=1))
                which = np.concatenate([np.arange(starts[p], starts[p + 1]) for p in places])
                score = np.repeat(exact, [starts[p + 1] - starts[p] for p in places])
                found = all_ids[which]
                other = found != query_id
                found, score = found[other], score[other]
                best = np.lexsort((found, score))[:k]
                out[0] += [query_id] * len(best)
                out[1] += found[best].tolist()
                out[2] += score[best].tolist()
            yield _result(out)

    return search


def _result(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(out, kinds)], ["query_id", "vec_id", "score"]
    )


def _anchored(location: str, k: int):
    """The nearest anchors of each query, which are rows of the table as any others."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(location)
        ids, owners = expanded(index.anchor_ids)
        for batch in batches:
            out: list[list] = [[], [], []]
            for own, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                score = np.sqrt(((index.anchors - np.array(vector, np.float64)) ** 2).sum(axis=1))[owners]
                score[ids == own] = np.inf
                best = np.lexsort((ids, score))[:k]
                best = best[np.isfinite(score[best])]
                out[0] += [own] * len(best)
                out[1] += ids[best].tolist()
                out[2] += score[best].tolist()
            yield _result(out)

    return answer


def nearest(
    table: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows found for each query: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    with another id. ``score`` is the Euclidean distance of the original vectors
    in double precision; equal ones go by id. Null, zero and non-finite vectors
    and rows without an id take no part; a table without others gives no rows.
    Every row is indexed; copies of a vector are searched as one and reported
    each, and a row that repeats an id and vector is one with the first.
    """
    spark = table.sparkSession
    rows, size = valid_vectors(table, vec_id, embedding)
    rows = rows.where(F.exists("vector", lambda v: v != 0))
    distinct = without_copies(rows, k + 1)
    if not size or distinct.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index, probes = fit(distinct, size, k)
    folder = shared_folder(spark, "vectors")
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    write_whole(files, f"{path}/index.npz", index.dump())
    location = f"{folder}/index.npz"
    listed = kept(distinct.select("ids", "vector").mapInArrow(_assigner(location), _LISTED))
    queries = kept(query_rows(rows, every))
    anchored = kept(queries.mapInArrow(_anchored(location, k), _FOUND))
    # The k-th nearest anchor bounds the distance of the k-th nearest row.
    far = anchored.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).alias("far"))
    bounds = queries.join(far, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", F.coalesce("far", F.lit(float("inf"))).alias("far"), "vector"
    )
    probed = bounds.mapInArrow(_prober(location, probes), _LISTED)
    blocks = lookup(
        kept(listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("bigint").alias("blocks")))
    )
    probed = kept(probed)
    groups = lookup(
        kept(probed.groupBy("list").agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("bigint").alias("groups")))
    )
    zero = F.lit(0).cast("bigint")
    members = (
        listed.join(blocks, "list")
        .join(groups, "list")
        .withColumn("block", F.pmod(F.xxhash64("vector"), F.col("blocks")))
        .withColumn("group", F.explode(F.sequence(zero, F.col("groups") - 1)))
    )
    askers = (
        probed.join(blocks, "list")
        .join(groups, "list")
        .withColumn("group", F.pmod(F.xxhash64("ids"), F.col("groups")))
        .withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    )
    cell = F.xxhash64("list", "block", "group").alias("cell")
    work = members.select(cell, F.lit(0).alias("role"), "ids", "vector").unionByName(
        askers.select(cell, F.lit(1).alias("role"), "ids", "vector")
    )
    found = (
        work.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(_searcher(location, k), _FOUND)
    )
    return best_rows(found.unionByName(anchored).distinct(), k, ascending=True)

