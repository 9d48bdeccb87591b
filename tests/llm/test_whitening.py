"""Whitening against numpy's own eigenvalues and exact integers."""

import math

import numpy as np
import pytest

from shelfwise.llm import whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, n int, Component string"


def expected(vectors, k=4):
    """(x rows, S, eigenvalues, covariance) from the given vectors, in numpy."""
    x = np.array([[math.floor(256.0 * float(np.float32(c))) for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    y = fit - fit.mean(axis=0)
    v = y.T @ y / len(fit)
    return x, fit, np.linalg.eigvalsh(v)[::-1][:k], v


def held(rows, vectors, ids, k=4):
    x, fit, values, v = expected(vectors, k)
    n, total = len(fit), fit.sum(axis=0)
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append(r)
    assert set(by) == set(range(1, k + 1)) and all(len(b) == len(x) for b in by.values())
    white = np.zeros((len(x), k))
    place = {i: at for at, i in enumerate(ids)}
    for c, b in by.items():
        for r in b:
            at = place[r.vec_id]
            white[at, c - 1] = r.whitened
            assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[at], total))
            assert abs(r.explained - values[c - 1] / np.trace(v)) <= 1e-9 and 0 <= r.identity_error < 1e-9
    # the projection's covariance over the fit list is the identity, and it lies on the eigenvectors
    y = x - total / n
    onto = np.linalg.lstsq(y, white, rcond=None)[0]
    assert np.allclose(v @ onto, onto * values, atol=1e-7 * values[0])
    return white


def test_sf_table(spark):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    held(whitening.query(spark, SF).collect(), [v for _, v in given], [i for i, _ in given])


def test_nulls_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    good = [list(map(float, r * [5, 1, 3, 0.5, 2, 1])) for r in rng.standard_normal((60, 6))]
    good += good[:5] * 40                                       # a hot group of copies counts once in the fit
    bad = [None, [], [1.0] * 5, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(1000 + i, v, 1, "x") for i, v in enumerate(bad)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))
    held(out.collect(), good, range(len(good)))
    again = whitening.whiten(spark.createDataFrame([(None, *r[1:]) for r in rows], SCHEMA))
    assert again.filter("vec_id IS NULL").count() == 4 * len(good)


def test_too_few_directions(spark):
    """No row for a component without spread; one vector or none gives no rows."""
    flat = [(i, [float(i), 2.0 * i, 7.0], 1, "x") for i in range(20)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()} == {1}
    for rows in ([], flat[:1], [(1, None, 1, "x")], [flat[3]] * 4):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_entries_beyond_exact_longs(spark):
    rows = [(i, [3.0e16 * (i - 2), 1.0e30 * (i % 2), float(i)], 1, "x") for i in range(5)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert out and all(r.deviation is None for r in out)


@pytest.mark.parametrize("kind", ["random", "equal", "pairs", "spread", "negative off-diagonal", "one"])
def test_leading_against_numpy(kind):
    rng = np.random.default_rng(5)
    n = 1 if kind == "one" else 24
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    e = {"random": rng.random(n), "equal": np.ones(n), "pairs": np.repeat(np.arange(1.0, 13.0), 2), "spread": 10.0 ** -np.arange(n),
         "negative off-diagonal": np.linspace(1, 1 + 1e-9, n), "one": np.array([2.0])}[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading(a, 4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    assert len(values) == min(4, n) and np.allclose(values, want, atol=1e-12 * want[0], rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-11 * want[0]


def test_inertia_against_eigenvalues():
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.standard_normal((n, n))
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            assert whitening.inertia(a) == (int((e > 0).sum()), 0, int((e < 0).sum()))
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1)
