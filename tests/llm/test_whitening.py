"""Whitening against exact fractions and numpy; multiple roots, lost rank, odd rows."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from delayengine.llm import whitening as w
from delayengine.llm.queries import op11_whitening, reach

SF = "/root/testdata/sf0.001"
DDL = "vec_id long, embedding array<double>, deviation string, n int"


def exact_polynomial(matrix):
    """det(xI - A) by the traces of powers, in fractions."""
    d = len(matrix)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(Fraction(int(matrix[i][t])) * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        product = [[sum(Fraction(int(matrix[i][t])) * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(product[i][i] for i in range(d)) / k)
    return [int(x) for x in reversed(c)]


def table(spark, vectors):
    reach(spark)
    return spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], DDL)


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_characteristic_polynomial(spark, d):
    reach(spark)
    x = np.random.default_rng(d).integers(-50, 50, (d + 2, d)).astype(object)
    if d == 7:
        x[:, 3] = 0  # a zero column: pivots are missing
        x[:, 5] = x[:, 4]
    square = x.T @ x
    assert w.characteristic(spark, square) == exact_polynomial(square)


def test_pivots_are_exchanged():
    a = np.array([[1, 0, 0, 5], [0, 2, 3, 0], [0, 3, 4, 7], [5, 0, 7, 0]], object)
    primes = w.primes_for(100)
    found = w.remaindered(w.polynomials_modulo(a, primes).tolist(), primes)
    assert found == exact_polynomial(a)


def test_primes():
    assert [n for n in range(11, 2000) if w._is_prime(n) and n % 2] == [n for n in range(11, 2000) if all(n % k for k in range(2, n))]
    assert w.primes_for(60)[0] == 2**31 - 1


def test_roots_are_counted_with_multiplicity():
    polynomial = [0, 0, 1]  # x^2 (x - 2)^2 (x - 5)
    for root in (2, 2, 5):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0], strict=True)]
    assert [w.above(polynomial, a) for a in (-1, 0, 1, 2, 4, 5, 6)] == [5, 3, 3, 1, 1, 0, 0]
    assert w.root(polynomial, 9, 1) == (5, 0, 1)
    assert w.root(polynomial, 9, 2)[:1] == w.root(polynomial, 9, 3)[:1] == (2,)
    assert w.root(polynomial, 9, 3)[1:] == (1, 2)


def brute_force(vectors):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    centred = (x * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], axes[:, ::-1]


def test_matches_numpy_on_the_whole_table(spark):
    reach(spark)
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, centred, values, axes = brute_force([r.embedding for r in given])
    rows = op11_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    assert [r.deviation for r in rows[::8]] == deviation
    got = np.array([r.whitened for r in rows]).reshape(n, 8)
    for k in range(8):
        want = centred @ axes[:, k] / math.sqrt(values[k])
        assert min(abs(got[:, k] - want).max(), abs(got[:, k] + want).max()) < 1e-9
        assert abs(rows[k].explained / (values[k] / values.sum()) - 1) < 1e-12
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_multiple_roots_give_orthonormal_components(spark):
    vectors = [[float(s if i == k else 0) for i in range(4)] for k in range(4) for s in (1, -1)]
    model = w.fit(table(spark, vectors))
    axes = np.stack([c.vector for c in model.components], 1)
    assert axes.shape == (4, 4) and abs(axes.T @ axes - np.eye(4)).max() < 1e-14
    assert {c.explained for c in model.components} == {0.25}
    rows = w.whitened_table(table(spark, vectors)).collect()
    assert len(rows) == 32 and rows[0].identity_error < 1e-12


def test_lost_rank_gives_fewer_components(spark):
    vectors = [[float(i), float(2 * i), 0.5] for i in range(6)]
    rows = w.whitened_table(table(spark, vectors)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 6
    assert rows[0].explained == 1.0 and rows[0].identity_error < 1e-12


def test_nearly_equal_roots_are_told_apart(spark):
    a, b = 1 << 40, (1 << 40) + 1
    vectors = [[a / 1024, 0.0], [-a / 1024, 0.0], [0.0, b / 1024], [0.0, -b / 1024]]
    first, second = w.fit(table(spark, vectors)).components
    assert abs(first.vector).tolist() == [0.0, 1.0] and abs(second.vector).tolist() == [1.0, 0.0]
    assert first.variance > second.variance


def test_odd_rows(spark):
    good = [[0.25, -1.5, 3.0], [1.0, 2.0, -0.1], [0.0, 0.7, 0.7], [0.0, 0.7, 0.7]]
    bad = [None, [], [None, 1.0, 2.0], [math.nan, 1.0, 2.0], [math.inf, 1.0, 2.0], [1e300, 1.0, 2.0]]
    n, deviation, centred, values, _ = brute_force(good)
    rows = w.whitened_table(table(spark, bad + good)).where("component = 1").orderBy("vec_id").collect()
    assert [(r.vec_id, r.n, r.deviation) for r in rows] == [(6 + i, n, x) for i, x in enumerate(deviation)]
    assert abs(rows[0].explained - values[0] / values.sum()) < 1e-12
    assert rows[2].whitened == rows[3].whitened
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for vectors in ([], bad, [[1.0, 2.0]] * 3):
        empty = w.whitened_table(table(spark, vectors))
        assert empty.columns == columns and empty.count() == 0
    with pytest.raises(ValueError, match="different lengths"):
        w.fit(table(spark, [[1.0], [1.0, 2.0]]))


def test_large_values_stay_exact(spark):
    vectors = [[2.0**50, 1.0], [-(2.0**50), 0.0], [3.0, 2.0**49]]
    n, sums, matrix = w.scatter(table(spark, vectors).select("embedding"))
    x = np.array([[math.floor(1024 * Fraction(c)) for c in v] for v in vectors], object)
    assert sums == list(x.sum(0)) and (matrix == n * (x.T @ x) - np.outer(x.sum(0), x.sum(0))).all()
    assert [r.deviation for r in w.whitened_table(table(spark, vectors)).collect()] == [None] * 6
    kept, found = w.integers(pa.array([[0.5], [None]], pa.list_(pa.float32())))
    assert kept.tolist() == [True, False] and found[1].tolist() == [[512]]
