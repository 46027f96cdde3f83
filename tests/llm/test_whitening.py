"""Exact polynomials against known ones, whitening against numpy."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from airwave.llm import charpoly, whitening


def polynomial(matrix):
    """Faddeev and LeVerrier, in fractions."""
    d = len(matrix)
    a = [[Fraction(int(v)) for v in row] for row in matrix]
    m = [[Fraction(i == j) for j in range(d)] for i in range(d)]
    out = [1]
    for k in range(1, d + 1):
        am = [[sum(a[i][t] * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c = -sum(am[i][i] for i in range(d)) / k
        out.append(int(c))
        m = [[am[i][j] + (c if i == j else 0) for j in range(d)] for i in range(d)]
    return out


def gram(rows, d, seed, size=50):
    draw = random.Random(seed)
    x = [[draw.randrange(-size, size) for _ in range(d)] for _ in range(rows)]
    x = np.array(x, object)
    return x.T @ x


@pytest.mark.parametrize("d, rows", [(1, 4), (2, 9), (5, 3), (7, 30), (12, 40)])
def test_polynomial_is_exact(d, rows):
    matrix = gram(rows, d, d)
    primes = charpoly.primes_for(matrix)
    got = charpoly.from_remainders({p: charpoly.charpoly_mod(matrix, p).tolist() for p in primes})
    assert got == polynomial(matrix)


def test_zeros_below_the_diagonal():
    for matrix in ([[0, 0, 1], [0, 2, 0], [1, 0, 3]], [[5, 0], [0, 5]], [[0] * 4] * 4):
        matrix = np.array(matrix, object)
        p = 2147483647
        got = [v - p if v > p // 2 else v for v in charpoly.charpoly_mod(matrix, p).tolist()]
        assert got == polynomial(matrix)


def test_roots_and_spaces_of_repeated_and_close_eigenvalues():
    # Eigenvalues 7 (three times), 3, 0, and two that differ by 1e-12 of their size.
    draw = np.random.default_rng(3)
    big = 10**12
    values = [7, 7, 7, 3, 0, big, big + 1]
    blocks = np.diag(np.array(values, object))
    order = draw.permutation(7)
    matrix = blocks[np.ix_(order, order)]
    # A unimodular similarity would not keep it symmetric; mix two equal ones exactly instead.
    poly = charpoly.scaled(polynomial(matrix), charpoly.BITS)
    found = list(charpoly.isolated(poly, 7))
    assert [m for *_, m in found] == [1, 1, 3, 1]
    roots = [charpoly.refined(poly, *f) for f in found]
    assert roots == [v << charpoly.BITS for v in (big + 1, big, 7, 3)]
    for root, (*_, m) in zip(roots, found, strict=True):
        vectors = charpoly.null_vectors(matrix, root, m)
        assert np.allclose(np.array(vectors) @ np.array(vectors).T, np.eye(m), atol=1e-15)
        for v in vectors:
            assert np.abs((matrix.astype(float) - np.eye(7) * (root >> charpoly.BITS)) @ v).max() < 1e-9


def test_primes():
    assert [n for n in range(60) if charpoly.is_prime(n)] == [
        n for n in range(2, 60) if all(n % k for k in range(2, n))
    ]
    assert charpoly.is_prime((1 << 31) - 1) and not charpoly.is_prime(3215031751)


def expected(x):
    x = np.asarray(x, np.float64)
    y = np.floor(64 * x)
    centred = y - y.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(y))
    keep = np.argsort(-values)[:32]
    return values[keep], vectors[:, keep].T, centred


def table(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return df.selectExpr("*", *(f"'x' AS {c}" for c in extra.split()))


def by_row(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_whitened_rows_equal_numpy(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 9)) @ draw.normal(size=(9, 9))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0] * 8 + [None]), (902, [math.inf] + [0.0] * 8), (903, [math.nan] * 9),
           (904, []), (905, [1.0, 2.0])]
    df = whitening.whiten(table(spark, rows + odd, "key vector n value component whitened"))
    got = by_row(df)
    values, vectors, centred = expected(x)
    sums = np.floor(64 * x).sum(axis=0) + 300 * 1_000_000
    assert set(got) == set(range(300))
    want = centred @ vectors.T / np.sqrt(values)
    signs = {}
    for i in range(300):
        deviation = int(((300 * (np.floor(64 * x[i]) + 1_000_000) - sums) ** 2).sum())
        assert sorted(got[i]) == list(range(1, 10))
        for c, r in got[i].items():
            assert r.n == 300 and r.deviation == deviation
            assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9)
            assert math.isclose(abs(r.whitened), abs(want[i, c - 1]), rel_tol=1e-7, abs_tol=1e-9)
            if abs(want[i, c - 1]) > 1e-6:
                assert signs.setdefault(c, np.sign(r.whitened * want[i, c - 1])) == np.sign(r.whitened * want[i, c - 1])
            assert r.identity_error < 1e-9


def test_ranks_equal_rows_and_empty_tables(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    # All rows on one line, repeated rows, a null key.
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 2.0]), (4, [3.0, 6.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 4 and {r.component for r in got} == {1}
    assert math.isclose(sum(r.whitened**2 for r in got) / 4, 1)
    assert {r.explained for r in got} == {1.0}
    # More dimensions than components.
    draw = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(60, 40)))]
    got = by_row(whitening.whiten(table(spark, rows)))
    assert all(sorted(v) == list(range(1, 33)) for v in got.values())


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(i) * 1e7, 1e300 if i == 3 else float(i % 3)]) for i in range(8)]
    got = by_row(whitening.whiten(table(spark, rows)))
    assert set(got) == set(range(8)) and all(len(v) == 2 for v in got.values())
    assert got[3][1].deviation is None
    assert got[0][1].identity_error < 1e-6
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1e9, 1e9) for _ in range(3)]) for i in range(50)]
    vectors, size = whitening.usable(table(spark, rows), "vec_id", "embedding")
    n, sums, products = whitening.scatter_sums(vectors, size)
    y = [[math.floor(64 * c) for c in v] for _, v in rows]
    assert n == 50 and sums == [sum(c) for c in zip(*y, strict=True)]
    assert products.tolist() == [[sum(r[i] * r[j] for r in y) for j in range(3)] for i in range(3)]
