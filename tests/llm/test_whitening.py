"""Exact spectra and whitening against direct arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from kiln.llm import charpoly, queries, whitening
from sample_tables import SMALL


def scatter(y):
    y = np.asarray(y, dtype=object)
    s = y.sum(axis=0)
    return (len(y) * y.T.dot(y) - np.outer(s, s)).tolist()


def polynomial(m):
    need, product, residues = 2 * charpoly.coefficient_bound(m), 1, {}
    for p in charpoly.primes():
        residues[p] = charpoly.char_poly_mod(charpoly.remainders(m, p), p)
        product *= p
        if product > need:
            return charpoly.from_residues(residues)


def exact_polynomial(m):
    """Faddeev-LeVerrier in fractions."""
    d = len(m)
    a = [[Fraction(x) for x in row] for row in m]
    times = lambda x, y: [[sum(x[i][k] * y[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    c, b = [Fraction(1)], [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    for k in range(1, d + 1):
        ab = times(a, b)
        c.append(-sum(ab[i][i] for i in range(d)) / k)
        b = [[ab[i][j] + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("d,n,seed", [(1, 3, 0), (2, 5, 1), (4, 9, 2), (7, 30, 3), (6, 4, 4)])
def test_characteristic_polynomials_are_exact(d, n, seed):
    y = np.random.default_rng(seed).integers(-2000, 2000, (n, d))
    y[:, -1] = y[:, 0]  # a null direction
    m = scatter(y)
    assert polynomial(m) == exact_polynomial(m)


def test_primes_are_prime():
    p = [x for x, _ in zip(charpoly.primes(), range(40))]
    assert p[0] == 2**31 - 1 and all(all(x % k for k in range(3, 46342, 2)) for x in p[:6]) and len(set(p)) == 40


def test_roots_with_multiplicity_and_zero():
    # (x - 3)**2 (x - 5) x**2
    poly = [0, 0, -45, 39, -11, 1]
    roots = [charpoly.kth_root(poly, k) for k in range(1, 6)]
    values = [Fraction(at, 1 << s) for at, s in roots]
    assert [round(float(v)) for v in values] == [5, 3, 3, 0, 0]
    assert all(abs(v - round(v)) < Fraction(1, 2**80) for v in values) and roots[3] == (0, 0)


def test_null_vectors_of_equal_roots_are_orthonormal():
    m = [[4, 1, 1, 0], [1, 4, 1, 0], [1, 1, 4, 0], [0, 0, 0, 3]]  # 6, 3, 3, 3
    poly = polynomial(m)
    v = np.array(charpoly.null_vectors(m, [charpoly.kth_root(poly, k) for k in (1, 2, 3, 4)]))
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.array(m) @ v.T - v.T * [6, 3, 3, 3]).max() < 1e-14


def test_products_of_any_longs_are_exact():
    rng = np.random.default_rng(1)
    for bits, n in ((10, 40_000), (17, 20_000), (18, 100), (40, 300), (62, 50)):
        y = rng.integers(-(2**bits), 2**bits, (n, 3))
        y[0] = -(2**bits)
        assert (whitening.exact_products(y) == y.astype(object).T.dot(y.astype(object))).all()


def reference(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    v = np.array([[float(Fraction(a, n * n)) for a in row] for row in scatter(x)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return (x - s / n) @ u / np.sqrt(e), deviation, e / np.trace(v)


def test_query_equals_floating_point_whitening(spark):
    rows = [r for r in queries.table(spark, SMALL, "embeddings").collect()]
    want, deviation, explained = reference([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = queries.op13_whitening(spark, SMALL).collect()
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)}
    w = np.zeros_like(want)
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
        assert 0 <= r.identity_error < 1e-10
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w * signs - want).max() < 1e-7
    assert np.abs(np.cov(w.T, bias=True) - np.eye(8)).max() < 1e-10


def test_rows_left_out_repeats_and_other_columns(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 2.0], 5), (1, [1.0, 2.0], 5), (None, [0.5, -1.0], 6), (3, [nan, 1.0], 7), (4, [1.0, None], 7), (5, None, 7),
        (6, [], 7), (7, [float("-inf"), 0.0], 7), (8, [0.25, 0.25], 7), (9, [1.0, 2.0, 3.0], 7),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got, model = whitening.whiten(df)
    rows = got.collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (8, 1), (8, 2)]
    assert {r.n for r in rows} == {4} and max(r.identity_error for r in rows) < 1e-12
    assert abs(sum(model.explained) - 1) < 1e-12


def test_directions_without_variance(spark):
    df = spark.createDataFrame([("a", [1.0, 1.0, 5.0]), ("b", [2.0, 2.0, 5.0]), ("c", [4.0, 4.0, 5.0])], "vec_id string, embedding array<float>")
    rows = whitening.whiten(df)[0].collect()
    assert {r.component: r.whitened is None for r in rows} == {1: False, 2: True, 3: True}
    assert {r.component: r.explained for r in rows} == {1: 1.0, 2: 0.0, 3: 0.0}
    one = whitening.whiten(df.limit(1))[0].collect()
    assert [(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one] == [(None, None, None, 0)] * 3
    empty, model = whitening.whiten(df.limit(0))
    assert empty.count() == 0 and model is None and empty.columns == whitening.whiten(df)[0].columns


def test_huge_entries_stay_exact(spark):
    vectors = [[1e12, -3.0], [2e12, 5.0], [-7e12, 1.5]]
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id int, embedding array<double>"))[0]
    _, deviation, _ = reference(vectors, 2)
    assert {r.vec_id: int(r.deviation) for r in got.collect()} == dict(enumerate(deviation))
