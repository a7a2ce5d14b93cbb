"""Whitening against exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from tidegate.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component string, k int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "c", 1, "v") for i, v in rows], SCHEMA)


def vectors(n, d, seed=0, scale=1.0):
    draw = np.random.default_rng(seed)
    return draw.standard_normal((n, d)) @ draw.standard_normal((d, d)) * scale


def exact(values):
    """(n, S, covariance) of floor(1024 c) + 100000, as fractions."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in row] for row in values]
    n, d = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(d)]
    centred = [[Fraction(n * row[i] - sums[i], n) for i in range(d)] for row in x]
    return x, n, sums, [[sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)]


@pytest.mark.parametrize(("n", "d", "scale"), [(50, 4, 1.0), (9, 3, 1e-3), (30, 5, 1e9), (12, 2, 1e14)])
def test_covariances_are_exact(spark, n, d, scale):
    values = vectors(n, d, scale=scale)
    x, _, sums, covariance = exact(values)
    fitted = whitening.fit(frame(spark, enumerate(values)))
    assert (fitted.n, list(fitted.sums)) == (n, sums)
    for i in range(d):
        for j in range(d):
            assert fitted.covariance[i, j] == pytest.approx(float(covariance[i][j]), rel=1e-15, abs=0)
    expected = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert fitted.deviations(np.array(x, np.int64)) == expected


def test_whitened_rows(spark):
    values = vectors(300, 12)
    x, n, sums, covariance = exact(values)
    rows = whitening.whitened_rows(frame(spark, enumerate(values))).collect()
    assert len(rows) == 300 * 8
    variances, components = np.linalg.eigh(np.array([[float(c) for c in r] for r in covariance]))
    order = np.argsort(-variances)[:8]
    expected = (np.array(x) - np.array(sums) / n) @ components[:, order] / np.sqrt(variances[order])
    found = np.zeros((300, 8))
    for r in rows:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == 300
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums, strict=True))
        assert r["explained"] == pytest.approx(variances[order][r["component"] - 1] / variances.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-9
    assert np.abs(np.cov(found.T, bias=True) - np.eye(8)).max() < 1e-9


def test_edges(spark):
    values = vectors(20, 3).tolist()
    good = list(enumerate(values)) + [(None, values[0]), (3, values[1]), (3, values[1])]
    bad = [(90, None), (91, []), (92, [1, None, 2]), (93, [1, float("nan"), 2]), (94, [1, float("inf"), 2]), (95, [1, 2])]
    found = whitening.whiten(frame(spark, good + bad)).collect()
    assert sorted({(r["vec_id"], r["component"]) for r in found if r["vec_id"] is not None}) == [(i, c) for i in range(20) for c in (1, 2, 3)]
    assert len(found) == 23 * 3
    assert {r["n"] for r in found} == {23}
    for few in ([], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])], bad[:5]):
        assert whitening.whiten(frame(spark, few)).collect() == []
    (one, other) = whitening.whiten(frame(spark, [(1, [0, 0]), (2, [1, 1])])).orderBy("vec_id").collect()
    assert (one["component"], abs(one["whitened"])) == (1, pytest.approx(1))
    assert one["explained"] == pytest.approx(1)
    assert one["whitened"] == -other["whitened"]


def test_entries_beyond_any_long(spark):
    rows = whitening.whitened_rows(frame(spark, [(1, [1e300, 0]), (2, [-1e300, 1]), (3, [0, 2])])).collect()
    assert {r["deviation"] for r in rows} == {None} or any(r["deviation"] is None for r in rows)
    assert all(np.isfinite(r["whitened"]) for r in rows)


def test_hot_vectors_and_many_rows(spark):
    values = np.concatenate([np.tile(vectors(1, 6), (3000, 1)), vectors(3000, 6, seed=2)])
    fitted = whitening.fit(frame(spark, enumerate(values)))
    x = np.floor(1024 * values).astype(np.int64) + 100_000
    assert list(fitted.sums) == x.sum(axis=0).tolist()
    z = (len(x) * x - x.sum(axis=0)).astype(object)
    exact_sums = z.T @ z
    for i in range(6):
        for j in range(6):
            assert fitted.covariance[i, j] == pytest.approx(exact_sums[i, j] / len(x) ** 3, rel=1e-15)


def test_digits_come_back():
    for value in (0, 1, -1, 2**40, -(2**90), 2**200 + 7):
        assert whitening.of_limbs(whitening.limbs(value)) == value
