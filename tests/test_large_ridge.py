"""Fits by conjugate gradients against dense algebra, and of more unknowns than the driver's matrix holds."""

import numpy as np
import pytest

from fieldglass.operators import models

OBS = "fold int, columns array<int>, y double, w double"


def made(spark, n, rows, seed, folds=5, width=4):
    rng = np.random.default_rng(seed)
    truth = rng.normal(size=n)
    out = []
    for k in range(rows):
        c = sorted(set(rng.integers(0, n, width).tolist()))
        out.append((k % folds if k % 7 else None, c, float(truth[c].sum() + rng.normal()), float(rng.integers(1, 9))))
    return spark.createDataFrame(out, OBS), out


def test_same_as_the_dense_solution(spark, monkeypatch):
    obs, _ = made(spark, 81, 600, 1)
    lambdas, light = (5.0, 50.0, 500.0), {80: 1.0}
    beta, lam, errors = models.ridge(obs, 81, "columns", "y", "w", "fold", lambdas, light)
    for at_once in (models.AT_ONCE, 81 * 4):  # all fits at once, and four
        monkeypatch.setattr(models, "AT_ONCE", at_once)
        monkeypatch.setattr(models, "MOST_UNKNOWNS", 10)
        got, best, own = models.ridge(obs, 81, "columns", "y", "w", "fold", lambdas, light)
        monkeypatch.undo()
        assert best == lam and own == pytest.approx(errors, rel=1e-9)
        assert np.abs(got - beta).max() < 1e-6


def test_more_unknowns_than_a_matrix_holds(spark):
    n = 20_000
    obs, rows = made(spark, n, 30_000, 2, folds=2)
    beta, lam, errors = models.ridge(obs, n, "columns", "y", "w", "fold", (20.0,), {0: 1.0})
    # The normal equations hold: computed row by row, without a matrix.
    w = np.array([r[3] for r in rows])
    y = np.array([r[2] for r in rows])
    y = y - (y * w).sum() / w.sum()
    pull = np.full(n, 20.0)
    pull[0] = 1.0
    left, right = pull * beta, np.zeros(n)
    for (_, c, _, weight), value in zip(rows, y, strict=True):
        left[c] += weight * beta[c].sum()
        right[c] += weight * value
    assert lam == 20.0 and np.abs(left - right).max() < 1e-7 * np.abs(right).max() and np.isfinite(errors[20.0])


def test_conjugate_gradients():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(30, 30))
    a = a @ a.T + np.eye(30)
    b = np.stack([rng.normal(size=30), np.zeros(30), a[:, 0]], axis=1)
    x = models.conjugate_gradients(lambda v: a @ v, b, np.diag(a)[:, None] * np.ones((1, 3)))
    assert np.allclose(a @ x, b, atol=1e-7) and not x[:, 1].any()
