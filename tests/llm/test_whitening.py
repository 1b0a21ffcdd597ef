import fractions

import numpy as np
import pytest

from episodeframes.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, n long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], i, "x") for i, v in rows], SCHEMA).repartition(5)


def expected(rows):
    """x, eigenvalues (falling) and vectors of the covariance by the dense solver."""
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    c = (len(x) * x - x.sum(axis=0)) / len(x)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    return x, c, e[::-1], v[:, ::-1]


def check(got, rows, components):
    x, c, e, v = expected(rows)
    n, by = len(rows), {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by) == sorted(i for i, _ in rows)
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    want = c @ v[:, :components] / np.sqrt(e[:components])
    have = np.array([[by[i][k + 1].whitened for k in range(components)] for i, _ in rows])
    assert all(len(by[i]) == components for i, _ in rows)
    assert [by[i][1].deviation for i, _ in rows] == deviation.tolist()
    assert {r.n for r in got} == {n}
    explained = np.array([by[rows[0][0]][k + 1].explained for k in range(components)])
    assert np.allclose(explained, e[:components] / e.sum(), rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8
    cov = have.T @ have / n
    assert np.abs(cov - np.eye(components)).max() < 1e-8
    return want, have


def test_against_the_dense_solver(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((700, 40)) @ rng.standard_normal((40, 40)))]
    want, have = check(W.whitened(frame(spark, rows)).collect(), rows, 32)
    assert np.allclose(have * np.sign((have * want).sum(axis=0)), want, atol=1e-8)


def test_dropped_rows_and_odd_tables(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((60, 3)))] + [(7, [1.0, 2.0, 3.0])] * 2
    odd = [(100, None), (101, []), (102, [1, None, 2]), (103, [1, 2, float("nan")]), (104, [float("inf"), 0, 0]), (105, [1, 2]), (106, [1, 2, 3, 4])]
    got = W.whitened(frame(spark, rows + odd)).collect()
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, k) for i, _ in rows for k in (1, 2, 3))
    assert W.whitened(frame(spark, [])).collect() == []
    assert W.whitened(frame(spark, odd[:3])).collect() == []
    assert W.whitened(frame(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []
    # null ids are carried; of equally frequent lengths the smallest stays
    got = W.whitened(frame(spark, [(None, [1, 5]), (2, [2, 7]), (3, [4, 1, 1]), (4, [0, 0, 1])])).collect()
    assert {r.vec_id for r in got} == {None, 2}


def test_rank_of_the_data(spark):
    """A repeated and a constant dimension leave fewer components."""
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 4))
    rows = [(i, [*r, r[0], 2.5]) for i, r in enumerate(v)]
    got = W.whitened(frame(spark, rows)).collect()
    assert max(r.component for r in got) == 4
    check(got, rows, 4)


def test_repeated_eigenvalues(spark):
    """Rows whose covariance is a multiple of the identity: any orthogonal directions do."""
    eye = np.eye(6) * 3
    rows = list(enumerate([*eye, *-eye] * 4))
    check(W.whitened(frame(spark, rows)).collect(), rows, 6)


@pytest.mark.parametrize("m", [1, 2, 3, 17, 64])
def test_bidiagonal_solver(m):
    rng = np.random.default_rng(m)
    for a in (rng.standard_normal((m, m)), np.diag(10.0 ** -np.arange(m) if m < 9 else np.ones(m)), rng.standard_normal((m, m)) * 10.0 ** -rng.integers(0, 6, m)):
        r = np.linalg.qr(a, mode="r")
        d, e, q = W.bidiagonal(r)
        b = np.diag(d) + np.diag(e, 1)
        assert np.allclose(q.T @ q, np.eye(m), atol=1e-12)
        assert np.allclose(b.T @ b, q.T @ r.T @ r @ q, atol=1e-10 * np.abs(r).max() ** 2)
        values = W.qd_eigenvalues(d, e)
        true = np.linalg.svd(b, compute_uv=False)
        assert np.allclose(np.sqrt(values), true, rtol=1e-10, atol=1e-14 * true[0])
        v = W.directions(d, e, values)
        assert np.allclose(v.T @ v, np.eye(m), atol=1e-7)
        assert np.allclose(b.T @ b @ v, v * values, atol=1e-7 * values[0])


def test_small_values_are_relatively_exact():
    """A graded bidiagonal: what a dense solver of B'B would lose."""
    d, e = 10.0 ** -np.arange(0.0, 12), 10.0 ** -np.arange(0.0, 11) / 3
    values = W.qd_eigenvalues(d, e)
    # the determinant of B'B is the product of the squares of the diagonal
    product = fractions.Fraction(1)
    for x in values.tolist():
        product *= fractions.Fraction(x)
    want = fractions.Fraction(1)
    for x in d.tolist():
        want *= fractions.Fraction(x) ** 2
    assert abs(float(product / want) - 1) < 1e-12


def test_deviation_beyond_64_bits_is_null(spark):
    got = W.whitened(frame(spark, [(1, [1e12, 0]), (2, [-1e12, 1]), (3, [0, 5])])).collect()
    assert {r.deviation for r in got if r.vec_id < 3} == {None}
