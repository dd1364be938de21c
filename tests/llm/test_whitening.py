import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).repartition(3)


def plain(vectors, most=4):
    """Every value by a dense eigendecomposition: {(vec_id, component): row}."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), dtype=object)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = np.array([[float(Fraction(int(c)) - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    _, s, components = np.linalg.svd(y)
    e = s**2 / n
    out = {}
    for i, x in good:
        centred = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k in range(min(most, len(e))):
            out.setdefault((i, k + 1), []).append((n, deviation, centred @ components[k] / math.sqrt(e[k]), e[k] / e.sum()))
    return out


def compare(found, wanted, close=1e-8):
    """Equal up to the sign of each component."""
    rows = {}
    for r in found.collect():
        rows.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert r["identity_error"] <= close
    assert {k: len(v) for k, v in rows.items()} == {k: len(v) for k, v in wanted.items()}
    signs = {}
    for key, many in wanted.items():
        for one, r in zip(many, rows[key]):
            assert (r["n"], r["deviation"]) == (one[0], one[1] if one[1] < 1 << 63 else None)
            assert r["explained"] == pytest.approx(one[3], rel=1e-9)
            assert abs(r["whitened"]) == pytest.approx(abs(one[2]), abs=close)
            if abs(one[2]) > 1e-6:
                signs.setdefault(key[1], set()).add(r["whitened"] * one[2] > 0)
    assert all(len(s) == 1 for s in signs.values())


def drawn(count, size, spreads, seed=5):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
    return [(i, (rng.normal(size=size) * spreads @ turn + 3).tolist()) for i in range(count)]


def test_equals_a_dense_decomposition(spark):
    vectors = drawn(300, 8, np.array([9, 5, 3, 2, 1, 0.5, 0.2, 0.1]))
    vectors += [(1000, vectors[0][1]), (1000, vectors[0][1]), (1001, vectors[5][1])]
    compare(whitening.whitened(table(spark, vectors)), plain(vectors))


def test_badly_conditioned_rows(spark):
    """Spreads that differ by 1e7, variances by 1e14: a decomposed covariance would lose the small ones."""
    vectors = drawn(200, 4, np.array([1e7, 1e4, 50.0, 1.0]))
    compare(whitening.whitened(table(spark, vectors)), plain(vectors), 1e-6)


def test_passes_reach_orthogonality(spark):
    rows, size = whitening.leveled(table(spark, drawn(200, 6, np.array([1e6, 1e3, 10, 5, 1, 0.5]))), 256)
    model = whitening.fit(rows, size, 4)
    assert 2 <= model.passes <= whitening.PASSES
    assert np.abs(model.components @ model.components.T - np.eye(6)).max() < 1e-12
    assert model.identity_error < 1e-10


def test_dimensions_without_spread_have_no_component(spark):
    vectors = [(i, [float(i), 2.0 * i, 7.0, float(i * i % 11)]) for i in range(40)]
    found = whitening.whitened(table(spark, vectors))
    assert sorted({r["component"] for r in found.collect()}) == [1, 2]
    wanted = {key: rows for key, rows in plain(vectors).items() if key[1] <= 2}
    compare(found, wanted)


def test_awkward_rows(spark):
    vectors = drawn(30, 3, np.array([4.0, 2.0, 1.0]))
    odd = [
        (50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]),
        (54, [1.0, float("inf"), 2.0]), (55, [1.0, 2.0]), (56, [1e300, 0.0, 0.0]), (None, [1.0, 2.0, 3.0]),
    ]
    docs = table(spark, vectors + odd)
    for name in ("x", "component", "n", "i", "place"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs.withColumn("notes", F.create_map(F.lit("a"), F.lit(1)))
    compare(whitening.whitened(docs), plain(vectors + [(None, [1.0, 2.0, 3.0])]))


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_too_little_to_whiten(spark, vectors):
    found = whitening.whitened(table(spark, vectors))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_deviation_is_exact_or_null():
    x = np.array([[1 << 33, -5], [3, 4]])
    assert whitening._deviations(x, 2, [(1 << 33) + 3, -1]) == [None, None]
    assert whitening._deviations(x[1:], 2, [(1 << 31) + 6, -1]) == [(1 << 62) + 81]
    assert whitening._deviations(np.array([[7, -5], [3, 4]]), 2, [10, -1]) == [16 + 81, 16 + 81]


def test_negative_zero_is_zero(spark):
    found = whitening.leveled(table(spark, [(1, [-0.0, 0.001]), (2, [-0.001, 0.0])]), 256)[0]
    assert sorted(r["x"] for r in found.collect()) == [[-1, 0], [0, 0]]


def test_query_on_the_given_table(spark):
    directory = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{directory}/embeddings.parquet").collect()]
    compare(queries.op11_whitening(spark, directory), plain(vectors))
