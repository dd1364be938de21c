"""Exact inner-product search with MaxScore.

A vector of whole numbers is a document whose terms are its dimensions. For one
query, what a term adds lies between two bounds that hold for a whole shard;
measured from the lower one, every term adds something between 0 and its own
bound. Terms whose bounds together cannot lift a document above the current
threshold are non-essential: the postings of the others are traversed, and the
non-essential ones are probed, largest bound first, only for documents that can
still reach the threshold. The best of all shards are merged.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, resident, shared_folder
from wordloom.llm.token_files import store, write_whole
from wordloom.llm.vectors import best_rows, expanded, matrix, query_rows, segments, valid_vectors, without_copies

#: Factor before rounding down.
SCALE = 64
#: Vectors whose best answers give each query its first threshold.
ANCHOR_ROWS = 2_000
#: Vectors of a shard, and queries that search it in one go.
SHARD_ROWS, GROUP_QUERIES = 4_096, 4_096
#: Queries of one product with the essential postings.
PRODUCT_QUERIES = 128
#: Non-essential terms that are probed between two cuts.
PROBE_TERMS = 4

_ASKED = "ids array<bigint>, vector array<double>"
_FOUND = "query_id bigint, vec_id bigint, score bigint"


class Shard:
    """Postings of a block of vectors, one column per term, with the bounds of each term."""

    def __init__(self, rows: np.ndarray):
        self.postings = np.ascontiguousarray(rows.T)
        self.least, self.most = rows.min(axis=0), rows.max(axis=0)

    def search(self, queries: np.ndarray, thresholds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query, places and scores of all documents that score its threshold or more."""
        ends = np.stack([queries * self.least, queries * self.most])
        floors, bounds = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
        orders = np.argsort(-bounds, axis=1, kind="stable")
        # rests[q, i]: what the terms of query q from the i-th on can add together.
        sorted_bounds = np.take_along_axis(bounds, orders, axis=1)
        rests = np.zeros((len(queries), bounds.shape[1] + 1))
        rests[:, :-1] = np.cumsum(sorted_bounds[:, ::-1], axis=1)[:, ::-1]
        needed = thresholds - floors.sum(axis=1)
        # The fewest leading terms whose followers cannot reach the threshold alone.
        essential = np.minimum((rests >= needed[:, None]).sum(axis=1), bounds.shape[1])
        leading = np.zeros(bounds.shape, bool)
        np.put_along_axis(leading, orders, np.arange(bounds.shape[1]) < essential[:, None], axis=1)
        # The postings of the essential terms, for all queries in one product.
        traversed = np.where(leading, queries, 0) @ self.postings + np.where(leading, 0, floors).sum(axis=1)[:, None]
        for query, floor, order, rest, first, score, threshold in zip(
            queries, floors, orders, rests, essential.tolist(), traversed, thresholds
        ):
            yield self._probe(query, floor, order, rest, first, score, threshold)

    def _probe(self, query, floor, order, rest, first, score, threshold) -> tuple[np.ndarray, np.ndarray]:
        """Probe the non-essential terms, largest bound first, where the threshold can still be reached."""
        alive = np.flatnonzero(score + rest[first] >= threshold)
        score = score[alive]
        for at in range(first, len(order), PROBE_TERMS):
            if not len(alive):
                break
            terms = order[at : at + PROBE_TERMS]
            score += query[terms] @ self.postings[terms[:, None], alive] - floor[terms].sum()
            good = score + rest[min(at + PROBE_TERMS, len(order))] >= threshold
            if not good.all():
                alive, score = alive[good], score[good]
        return alive, score


def _best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = ids != own
    ids, scores = ids[other], scores[other]
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def _anchors(location: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def load() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        files, path = store(location)
        with files.open_input_file(path) as file:
            found = np.load(io.BytesIO(file.read()))
        return found["rows"], found["ids"], found["owners"]

    return resident(("anchors", location), load)


def _asker(location: str, k: int):
    """Queries with their first threshold, the k-th best score among the anchors."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, owners = _anchors(location)
        for batch in batches:
            own = batch.column(0).to_numpy()
            vectors = matrix(batch.column(1)).astype(np.float64)
            bounded = []
            for query_id, query in zip(own.tolist(), vectors):
                scores = (rows @ query)[owners][ids != query_id]
                threshold = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -math.inf
                bounded.append(np.append(query, threshold))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own[:, None]), pa.list_(pa.int64())), pa.array(bounded, pa.list_(pa.float64()))],
                ["ids", "vector"],
            )

    return ask


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, rows, shard = None, [], [], None
        for this, role, their_ids, vectors in segments(batches):
            if this != cell:
                cell, ids, rows, shard = this, [], [], None
            if role == 0:
                ids += their_ids
                rows.append(vectors)
                continue
            if not rows:
                continue
            if shard is None:
                shard = Shard(np.concatenate(rows))
                all_ids, owners = expanded(ids)
                starts = np.searchsorted(owners, np.arange(len(ids) + 1))
            out: list[list] = [[], [], []]
            answers = (
                answer
                for at in range(0, len(vectors), PRODUCT_QUERIES)
                for answer in shard.search(vectors[at : at + PRODUCT_QUERIES, :-1], vectors[at : at + PRODUCT_QUERIES, -1])
            )
            for own, (places, scores) in zip(their_ids, answers):
                if not len(places):
                    continue
                counts = starts[places + 1] - starts[places]
                which = np.repeat(starts[places] + counts - np.cumsum(counts), counts) + np.arange(counts.sum())
                found, scores = _best(all_ids[which], np.repeat(scores, counts), own[0], k)
                out[0] += own * len(found)
                out[1] += found.tolist()
                out[2] += np.rint(scores).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in out], ["query_id", "vec_id", "score"]
            )

    return search


def best_products(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` highest inner products of each query: (query_id, rank, vec_id, score).

    Components count as floor(scale * x). Queries are the rows whose id is
    divisible by ``every``, candidates all rows with another id; equal scores go
    by id. The result is exact. Null and non-finite vectors, those of an uncommon
    length and rows without an id take no part; nor do vectors with a component
    so large that a sum of ``size`` products could pass 2^53, up to where doubles
    hold every whole number (some 185,000 for 64 dimensions and the usual scale).
    A table without others gives no rows. Copies of a vector
    are searched as one and reported each; a row that repeats an id and vector
    is one with the first.
    """
    spark = table.sparkSession
    rows, size = valid_vectors(table, vec_id, embedding)
    whole = F.transform("vector", lambda v: F.floor(v.cast("double") * scale).cast("double"))
    most = math.sqrt((1 << 53) / max(size, 1))
    rows = rows.select("vec_id", whole.alias("vector")).where(F.forall("vector", lambda v: F.abs(v) <= most))
    distinct = without_copies(rows, k + 1)
    if not size or distinct.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sample = distinct.orderBy(F.xxhash64("vector"), "ids").limit(ANCHOR_ROWS).select("ids", "vector").collect()
    ids, owners = expanded([row["ids"] for row in sample])
    folder = shared_folder(spark, "products")
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    out = io.BytesIO()
    np.savez(out, rows=np.array([row["vector"] for row in sample]), ids=ids, owners=owners)
    write_whole(files, f"{path}/anchors.npz", out.getvalue())
    asked = kept(query_rows(rows, every).mapInArrow(_asker(f"{folder}/anchors.npz", k), _ASKED))
    shards = max(1, math.ceil(distinct.count() / SHARD_ROWS))
    groups = max(1, math.ceil(asked.count() / GROUP_QUERIES))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    members = distinct.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards))).withColumn("group", every_group)
    askers = asked.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups))).withColumn("shard", every_shard)
    cell = (F.col("shard") * groups + F.col("group")).cast("bigint").alias("cell")
    work = members.select(cell, F.lit(0).alias("role"), "ids", "vector").unionByName(
        askers.select(cell, F.lit(1).alias("role"), "ids", "vector")
    )
    found = work.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(_searcher(k), _FOUND)
    return best_rows(found, k, ascending=False)
