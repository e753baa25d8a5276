"""Whitening against a dense eigensolver."""

import math

import numpy as np
import pytest

from roomledger.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, id string, x int, n int, white string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "a", 1, 2, None) for i, v in vectors], SCHEMA)


def dense(vectors):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], np.int64)
    e, u = np.linalg.eigh(np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], -1))
    return x, e[::-1], u[:, ::-1]


def check(rows, ids, vectors, components):
    x, e, u = dense(vectors)
    n, sums = len(x), x.sum(0)
    assert len(rows) == n * components
    white = (x - sums / n) @ u[:, :components] / np.sqrt(e[:components])
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
    got = np.array([[by[i][c + 1]["whitened"] for c in range(components)] for i in ids])
    signs = np.sign((got * white).sum(0))
    assert np.abs(got - white * signs).max() < 1e-8
    for i, row in zip(ids, x):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        assert all(int(r["deviation"]) == exact for r in by[i].values())


@pytest.mark.parametrize("dimensions", [64, 40, 5])
def test_whitening_equals_the_dense_solution(spark, dimensions):
    random = np.random.RandomState(dimensions)
    vectors = (random.standard_normal((400, dimensions)) * np.linspace(1, 0.2, dimensions)).astype(np.float32).tolist()
    rows = whitening.whitened(table(spark, enumerate(vectors)).repartition(5)).collect()
    check(rows, range(400), vectors, min(8, dimensions))


def test_whitening_of_odd_rows(spark):
    random = np.random.RandomState(1)
    vectors = random.standard_normal((50, 6)).astype(np.float32).tolist()
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [math.nan] * 6), (104, [math.inf] * 6), (105, [1.0, 2.0])]
    rows = whitening.whitened(table(spark, [*enumerate(vectors), *odd])).collect()
    assert {r["vec_id"] for r in rows} == set(range(50))
    check(rows, range(50), vectors, 6)
    # Repeated rows and null ids count each.
    again = whitening.whitened(table(spark, [(None, v) for v in vectors[:20]] + [(3, vectors[20])] * 30)).collect()
    assert len(again) == 50 * 6 and all(r["n"] == 50 for r in again)


def test_whitening_without_variance(spark):
    for vectors in ([], [(1, [1.0, 2.0])], [(i, [0.5, 0.25, 1.0]) for i in range(9)], [(1, None)]):
        frame = whitening.whitened(table(spark, vectors))
        assert frame.collect() == []
        assert frame.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # Variance in two directions gives two components.
    flat = [(i, [float(i), float(-i), float(i * i), 1.0]) for i in range(30)]
    assert {r["component"] for r in whitening.whitened(table(spark, flat)).collect()} == {1, 2}


def test_entries_out_of_range_and_exact_deviations(spark):
    rows = whitening.whitened(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])])).collect()
    x = [[2**30 + 100_000, 100_000], [-(2**30) + 100_000, 101_024], [100_000, 100_512]]
    sums = [sum(c) for c in zip(*x)]
    want = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == want


def test_filtered_iteration_parts_close_values():
    """Eigenvalues that differ by a thousandth, and a tie."""
    random = np.random.RandomState(3)
    u = np.linalg.qr(random.standard_normal((100, 100)))[0]
    e = np.r_[2.0, 1.002, 1.001, 1.0, 0.9, 0.9, 0.85, 0.8, np.linspace(0.7, 0, 92)]
    v = (u * e) @ u.T
    values, vectors, rest = whitening.leading(v, 100, whitening.Iteration())
    assert np.abs(values - e[:8]).max() < 1e-12 and rest < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    with pytest.raises(ArithmeticError):
        whitening.leading(v, 100, whitening.Iteration(sweeps=1))
