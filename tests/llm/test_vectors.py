import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from wordloom.llm import ann, maxscore

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


def made(count, size, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(n, [float(x) for x in rng.standard_normal(size).astype(np.float32)]) for n in range(count)]
    return rows + [(count + n, rows[3][1]) for n in range(copies)]


def awkward(size=4):
    inf, nan = float("inf"), float("nan")
    return [
        (1000, None),
        (1020, [None] * size),
        (1040, [inf] + [0.5] * (size - 1)),
        (1060, [nan] * size),
        (1100, [1.0] * (size + 1)),
        (1200, []),
        (None, [0.5] * size),
        (1300, [0.0] * size),
        (1301, [-0.0] * size),
        (1400, [0.25] * size),
        (1401, [0.25] * size),
        (1401, [0.25] * size),
    ]


def usable(rows, size, zero):
    seen = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or len(vector) != size or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if zero or any(vector):
            seen[vec_id] = np.array(vector, np.float32).astype(np.float64)
    return seen


def plain(rows, size, k, every, score, sign, zero):
    vectors = usable(rows, size, zero)
    out = []
    for query in sorted(i for i in vectors if i % every == 0):
        found = sorted((sign * score(vectors[query], v), i) for i, v in vectors.items() if i != query)[:k]
        out += [(query, rank, i, sign * s) for rank, (s, i) in enumerate(found, 1)]
    return out


def distance(a, b):
    return float(np.sqrt(((a - b) ** 2).sum()))


def product(a, b):
    return int(np.floor(64 * a) @ np.floor(64 * b))


@pytest.mark.parametrize("rows,size", [(made(400, 16, 1, 60), 16), (made(30, 4, 2) + awkward(), 4), (made(1, 3, 1), 3)])
def test_products_are_exact(spark, rows, size, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 64)
    monkeypatch.setattr(maxscore, "GROUP_QUERIES", 8)
    monkeypatch.setattr(maxscore, "ANCHOR_ROWS", 40)
    found = sorted(map(tuple, maxscore.best_products(table(spark, rows), 20, 20).collect()))
    assert found == plain(rows, size, 20, 20, product, -1, True)


def test_shard_search_loses_nothing():
    rng = np.random.default_rng(8)
    rows = np.floor(rng.standard_normal((300, 24)) * 20)
    shard = maxscore.Shard(rows)
    for _ in range(40):
        query = np.floor(rng.standard_normal(24) * 20)
        scores = rows @ query
        thresholds = np.array([-np.inf, np.sort(scores)[-10], scores.max(), scores.max() + 1])
        found = shard.search(np.tile(query, (4, 1)), thresholds)
        for threshold, (places, got) in zip(thresholds, found):
            assert places.tolist() == np.flatnonzero(scores >= threshold).tolist()
            assert (got == scores[places]).all()
    zero = np.zeros((1, 24))
    assert len(next(shard.search(zero, np.zeros(1)))[0]) == 300


@pytest.mark.parametrize("rows,size", [(made(30, 4, 2) + awkward(), 4), (made(12, 4, 5, 400), 4), (made(1, 3, 1), 3)])
def test_nearest_in_small_tables_is_exact(spark, rows, size, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 2)
    found = sorted(map(tuple, ann.nearest(table(spark, rows), 10, 20).collect()))
    wanted = plain(rows, size, 10, 20, distance, 1, False)
    assert [row[:3] for row in found] == [row[:3] for row in wanted]
    assert [row[3] for row in found] == pytest.approx([row[3] for row in wanted])


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 60)
    rows = made(3000, 32, 6)
    found = {tuple(row)[::2] for row in ann.nearest(table(spark, rows), 10, 50).select("query_id", "rank", "vec_id").collect()}
    wanted = {(row[0], row[2]) for row in plain(rows, 32, 10, 50, distance, 1, False)}
    assert len(found & wanted) / len(wanted) >= 0.9


def test_scan_gives_up_far_vectors_and_keeps_near_ones():
    rng = np.random.default_rng(2)
    rows, turn = rng.standard_normal((2000, 64)), ann.rotation(64)
    kept = lost = near = 0
    for query in rng.standard_normal((20, 64)):
        square = ((rows - query) ** 2).sum(axis=1)
        bound = np.sort(square)[20]
        places = set(ann.scan_block((rows @ turn).T.copy(), query @ turn, bound).tolist())
        true = set(np.flatnonzero(square <= bound).tolist())
        assert places <= true
        lost += len(true - places)
        near += len(true)
    assert lost / near < 0.05
    assert np.allclose(turn @ turn.T, np.eye(64))


@pytest.mark.parametrize("search", [ann.nearest, maxscore.best_products])
def test_tables_without_usable_vectors(spark, search):
    assert search(table(spark, [])).collect() == []
    assert search(table(spark, [(0, None), (20, [float("nan")])])).collect() == []


def test_extra_columns_with_clashing_names(spark):
    rows = made(60, 4, 9)
    random.Random(1).shuffle(rows)
    clash = table(spark, rows).selectExpr("*", "1 AS vector", "2 AS score", "3 AS rank", "4 AS cell", "5 AS ids")
    for search in (ann.nearest, maxscore.best_products):
        assert sorted(map(tuple, search(clash).collect())) == sorted(map(tuple, search(table(spark, rows)).collect()))


def test_components_too_large_for_exact_sums_take_no_part(spark):
    rows = [(at, [float(at), 1.0, 2.0]) for at in range(0, 60, 5)] + [(3, [1e300, 0.0, 0.0]), (20, [-1e300, 1.0, 1.0]), (6, [1e9, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = maxscore.best_products(table, k=3, every=20)
    good = {at: [64 * at, 64, 128] for at, _ in rows[:12]}
    for query in (0, 20, 40):
        wanted = sorted(((-sum(a * b for a, b in zip(good[query], v)), at) for at, v in good.items() if at != query))[:3]
        assert [(r["vec_id"], r["score"]) for r in found.where(F.col("query_id") == query).orderBy("rank").collect()] == [(at, -s) for s, at in wanted]
