"""The state-space likelihood against dense covariance matrices, and forecasts over gaps."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast.functions import state_space as S
from foldcast.operators import arima, auto_arima, gaps
from foldcast.operators.folds import Rolling

START = dt.date(2018, 1, 1)
ROLLING = Rolling("2018-01-01", "2020-11-30", "2021-01-25", horizon=4, step=8)


def dense(y, ar, ma, integrated, horizon):
    """Log-likelihood, mean or drift, variance, forecasts and their errors from the whole covariance."""
    psi = [1.0]
    for k in range(1, 4000):
        psi.append((ma[k - 1] if k <= len(ma) else 0.0) + sum(a * psi[k - 1 - i] for i, a in enumerate(ar) if k - 1 - i >= 0))
    psi, n = np.array(psi), len(y) + horizon
    gamma = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n)])
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    x, base = np.ones(n), 0.0
    if integrated:
        total = np.tril(np.ones((n, n)))
        total[:, 0] = 0.0
        cov, x, base = total @ cov @ total.T, np.arange(n) * 1.0, y[0]
    known = np.flatnonzero(~np.isnan(y))
    known = known[known > 0] if integrated else known
    v, u, later = y[known] - base, x[known], np.arange(len(y), n)
    inverse = np.linalg.inv(cov[np.ix_(known, known)])
    beta = u @ inverse @ v / (u @ inverse @ u)
    e = v - beta * u
    variance = e @ inverse @ e / len(v)
    loglik = -0.5 * (len(v) * (np.log(2 * np.pi * variance) + 1) + np.linalg.slogdet(cov[np.ix_(known, known)])[1])
    across = cov[np.ix_(later, known)] @ inverse
    spread = np.diag(cov[np.ix_(later, later)] - across @ cov[np.ix_(known, later)])
    return loglik, beta, variance, base + beta * x[later] + across @ e, np.sqrt(variance * spread)


@pytest.mark.parametrize("integrated", [False, True])
@pytest.mark.parametrize("ar, ma", [([], []), ([0.6], []), ([], [0.5]), ([0.5, -0.3], [0.4]), ([0.2], [-0.6, 0.3])])
def test_likelihood_equals_the_dense_form(ar, ma, integrated):
    rng = np.random.default_rng(3)
    whole = rng.normal(size=(3, 26)).cumsum(axis=1) * 0.5 + 4
    whole[0, [4, 5, 6, 12]] = np.nan
    whole[1, [2, 24, 25]] = np.nan
    whole[2, :7] = np.nan
    start = np.array([0, 0, 7])
    found = S.kalman(whole, start, np.tile(ar, (3, 1)).reshape(3, -1), np.tile(ma, (3, 1)).reshape(3, -1), integrated, 5)
    for i in range(3):
        expected = dense(whole[i, start[i]:], ar, ma, integrated, 5)
        for name, value in zip(["loglik", "beta", "variance", "mean", "error"], expected, strict=True):
            assert found[name][i] == pytest.approx(value, rel=1e-7), name


def test_search_reaches_the_best_of_a_grid():
    rng = np.random.default_rng(8)
    y = [0.0]
    for _ in range(200):
        y.append(0.7 * y[-1] + rng.normal())
    y = np.array(y)
    y[40:60] = np.nan
    y[::7] = np.where(np.arange(0, 201, 7) == 0, y[::7], np.nan)
    start = np.zeros(1, int)
    grid = [S.kalman(y[None], start, np.array([[a]]), np.zeros((1, 0)), False)["loglik"][0] for a in np.arange(-0.98, 0.981, 0.005)]
    free, best = S.most_likely(y[None], start, 1, 0, False)
    assert best[0] >= max(grid) - 1e-4
    assert S.stable_coefficients(free)[0, 0] == pytest.approx(0.7, abs=0.2)


def test_choice_at_the_edges():
    got = S.choose(pd.Series([[5.0], [3.0, None, 3.0, None], [2.0, None], [1.0] * 30]), pd.Series([0, 0, 1, 1]), 2, 3)
    assert [list(m) for m in got["mean"]] == [pytest.approx([v] * 3) for v in (5.0, 3.0, 2.0, 1.0)]
    assert (got.p + got.q == 0).all() and np.isfinite(np.stack(got["error"])).all()
    assert S.choose(pd.Series([], dtype=object), pd.Series([], dtype=int), 2, 3).empty


def test_gaps_are_not_taken_for_zeros(spark):
    rng, z = np.random.default_rng(1), [0.0]
    for _ in range(169):
        z.append(0.6 * z[-1] + rng.normal())
    rows = [(name, START + dt.timedelta(days=7 * i), 20.0 + v) for name in ("a", "b") for i, v in enumerate(z)
            if name == "a" or i < 2 or i % 3]
    panel = spark.createDataFrame(rows, "series string, period date, qty double")
    models = gaps.fit(arima.fold_grid(panel, ROLLING, fill="none"), 4)
    rows = {(r.series, r.fold): r for r in gaps.coefficients(models).collect()}
    assert {s for s, _ in rows} == {"a", "b"}
    for (name, _), r in rows.items():
        assert r.n_rows + r.n_unknown in (152, 160) and (r.n_unknown > 40) == (name == "b")
    ahead = auto_arima.forecast(models).collect()
    assert len(ahead) == 2 * 2 * 4
    for r in ahead:
        assert r.forecast_value == pytest.approx(20.0, abs=5.0)
        assert r.prediction_interval_lower_bound < r.forecast_value < r.prediction_interval_upper_bound
    assert gaps.fit(arima.fold_grid(panel.where("false"), ROLLING, fill="none"), 4).count() == 0
    assert models.where(F.col("loglik").isNull()).count() == 0
