"""Exact Gaussian likelihood of ARMA models over series with unknown periods.

Groups of a batch are filtered side by side, period by period. An unknown period (NaN) moves
the state on and adds nothing to the likelihood. Mean and variance are concentrated out.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from foldcast.functions.kernels import largest_root

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_VARIANCE = 1e-12
#: Groups that are filtered together; bounds the memory of a task.
BATCH = 1024


def stable_coefficients(free: np.ndarray) -> np.ndarray:
    """Coefficients of a stable autoregression from free parameters, one row per group, by
    way of its partial autocorrelations (Durbin-Levinson)."""
    partial = 0.99 * np.tanh(free)
    out = np.zeros_like(partial)
    for k in range(partial.shape[1]):
        before = out[:, :k].copy()
        out[:, :k] = before - partial[:, [k]] * before[:, ::-1]
        out[:, k] = partial[:, k]
    return out


def transition(ar: np.ndarray, ma: np.ndarray, integrated: bool
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transition matrices, loadings of the shock and first covariances. An integrated
    series has its level in front of the state, known at its first period."""
    n, p, q = len(ar), ar.shape[1], ma.shape[1]
    r = max(p, q + 1)
    move, load = np.zeros((n, r, r)), np.zeros((n, r))
    move[:, :p, 0] = ar
    move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    load[:, 0], load[:, 1:q + 1] = 1.0, ma
    shock = load[:, :, None] * load[:, None, :]
    both = np.einsum("nij,nkl->nikjl", move, move).reshape(n, r * r, r * r)
    first = np.linalg.solve(np.eye(r * r) - both, shock.reshape(n, r * r, 1)).reshape(n, r, r)
    if integrated:
        wide, start = np.zeros((n, r + 1, r + 1)), np.zeros((n, r + 1, r + 1))
        wide[:, 0, 0], wide[:, 0, 1:], wide[:, 1:, 1:] = 1.0, move[:, 0], move
        start[:, 1:, 1:] = first
        move, first, load = wide, start, np.column_stack([load[:, 0], load])
    return move, load, first


def kalman(y: np.ndarray, start: np.ndarray, ar: np.ndarray, ma: np.ndarray, integrated: bool,
           horizon: int = 0) -> dict[str, np.ndarray]:
    """Filter series that end together (rows of ``y``, NaN where unknown) from the period
    ``start`` on, then ``horizon`` periods ahead.

    The mean of a stationary series, or the drift of an integrated one, is found by running a
    constant, or a line, through the same filter (generalised least squares).
    """
    n, length = y.shape
    move, load, p = transition(ar, ma, integrated)
    shock = load[:, :, None] * load[:, None, :]
    # Two columns go through: the series and its regressor.
    state = np.zeros((n, move.shape[1], 2))
    base = y[np.arange(n), start][:, None] if integrated else np.zeros((n, 1))
    line = np.arange(length + horizon)[None, :] - start[:, None] if integrated else np.ones((n, length + horizon))
    data = np.stack([np.pad(y - base, ((0, 0), (0, horizon)), constant_values=np.nan), line], axis=2)
    sums, logs, count = np.zeros((n, 3)), np.zeros(n), np.zeros(n)
    ahead, spread = np.zeros((n, horizon, 2)), np.zeros((n, horizon))
    for t in range(length + horizon):
        moved = (t > start)[:, None, None]
        state = np.where(moved, move @ state, state)
        p = np.where(moved, move @ p @ move.transpose(0, 2, 1) + shock, p)
        if t >= length:
            ahead[:, t - length] = state[:, 0]
            spread[:, t - length] = p[:, 0, 0]
            continue
        f = p[:, 0, 0]
        seen = ~np.isnan(data[:, t, 0]) & (t >= start + int(integrated)) & (f > 0)
        error = np.where(seen[:, None], np.nan_to_num(data[:, t]) - state[:, 0], 0.0)
        f = np.where(seen, f, 1.0)
        gain = np.where(seen[:, None], p[:, :, 0] / f[:, None], 0.0)
        state = state + gain[:, :, None] * error[:, None, :]
        p = p - gain[:, :, None] * np.where(seen[:, None], p[:, 0], 0.0)[:, None, :]
        sums += np.stack([error[:, 0] ** 2, error[:, 0] * error[:, 1], error[:, 1] ** 2], 1) / f[:, None]
        logs += np.log(f)
        count += seen
    beta = np.where(sums[:, 2] > 0, sums[:, 1] / np.where(sums[:, 2] > 0, sums[:, 2], 1.0), 0.0)
    variance = np.maximum(sums[:, 0] - beta * sums[:, 1], 0.0) / np.maximum(count, 1)
    held = np.maximum(variance, LEAST_VARIANCE)
    out = {"beta": beta, "variance": variance, "count": count,
           "loglik": -0.5 * (count * (np.log(2 * np.pi * held) + 1) + logs)}
    if horizon:
        level = data[:, length:, 1]
        out["mean"] = base + ahead[:, :, 0] + beta[:, None] * (level - ahead[:, :, 1])
        out["error"] = np.sqrt(np.maximum(variance[:, None] * spread, 0.0))
    return out


def _coefficients(free: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    return stable_coefficients(free[:, :p]), -stable_coefficients(free[:, p:])


def most_likely(y: np.ndarray, start: np.ndarray, p: int, q: int, integrated: bool,
                rounds: int = 40, least_step: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Free parameters of the greatest likelihood, and that likelihood, by compass search;
    a group leaves the search once its step is small."""
    n = len(y)
    free, step = np.zeros((n, p + q)), np.full(n, 0.5)
    best = kalman(y, start, *_coefficients(free, p), integrated)["loglik"]
    for _ in range(rounds if p + q else 0):
        live = np.flatnonzero(step >= least_step)
        if not len(live):
            break
        moved = np.zeros(len(live), bool)
        for j in range(p + q):
            for sign in (1.0, -1.0):
                trial = free[live]
                trial[:, j] += sign * step[live]
                value = kalman(y[live], start[live], *_coefficients(trial, p), integrated)["loglik"]
                better = value > best[live] + 1e-9
                free[live[better]], best[live[better]] = trial[better], value[better]
                moved |= better
        step[live[~moved]] /= 2
    return free, best


def choose(histories: pd.Series, d: pd.Series, max_order: int, horizon: int) -> pd.DataFrame:
    """The ARMA(p, q) of least AIC with p + q <= max_order for each array (NULL where
    unknown, its first value known), by exact likelihood, and its forecasts."""
    rows = [np.array([np.nan if v is None else v for v in a], dtype=float) for a in histories]
    n = len(rows)
    out = {"p": np.zeros(n, int), "q": np.zeros(n, int), "ar": [[]] * n, "ma": [[]] * n,
           "level_or_drift": np.zeros(n), "variance": np.zeros(n), "aic": np.full(n, np.inf),
           "loglik": np.zeros(n), "mean": [None] * n, "error": [None] * n}
    kinds = d.to_numpy()
    for integrated in (False, True):
        # Histories of like length go together, so that little is padding.
        own = sorted(np.flatnonzero((kinds == 1) == integrated), key=lambda i: len(rows[i]))
        for at in range(0, len(own), BATCH):
            part = np.array(own[at:at + BATCH])
            longest = max(len(rows[i]) for i in part)
            start = np.array([longest - len(rows[i]) for i in part])
            y = np.stack([np.pad(rows[i], (longest - len(rows[i]), 0), constant_values=np.nan)
                          for i in part])
            for p in range(max_order + 1):
                for q in range(max_order + 1 - p):
                    free, _ = most_likely(y, start, p, q, integrated)
                    ar, ma = _coefficients(free, p)
                    found = kalman(y, start, ar, ma, integrated, horizon)
                    aic = 2 * (p + q + 2) - 2 * found["loglik"]
                    usable = (found["count"] > 2 * (p + q + 2)) | (p + q == 0)
                    usable &= (largest_root(ar) < 0.995) & (largest_root(-ma) < 0.995)
                    for k in np.flatnonzero(usable & (aic < out["aic"][part] - 1e-9)):
                        i = part[k]
                        out["p"][i], out["q"][i], out["aic"][i] = p, q, aic[k]
                        out["ar"][i], out["ma"][i] = ar[k], ma[k]
                        out["level_or_drift"][i] = found["beta"][k]
                        out["variance"][i], out["loglik"][i] = found["variance"][k], found["loglik"][k]
                        out["mean"][i], out["error"][i] = found["mean"][k], found["error"][k]
    return pd.DataFrame(out)
