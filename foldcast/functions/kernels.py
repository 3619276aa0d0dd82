"""Small numeric helpers that run inside tasks on batches of groups."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RIDGE = 1e-10


def unpack(moments: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (N), means (N, k) and centred product sums (N, k, k) of moment arrays."""
    m = np.stack([np.nan_to_num(np.asarray(row, dtype=float)) for row in moments])
    k = int((np.sqrt(9 + 8 * (m.shape[1] - 1)) - 3) / 2)
    n, sums = m[:, 0], m[:, 1:k + 1]
    i, j = np.triu_indices(k)
    cross = np.zeros((len(m), k, k))
    cross[:, i, j] = cross[:, j, i] = m[:, k + 1:]
    mean = sums / np.maximum(n, 1)[:, None]
    return n, mean, cross - n[:, None, None] * mean[:, :, None] * mean[:, None, :]


def solve_spd(a: np.ndarray, b: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Solve a x = b per group. Directions without variation get 0."""
    diagonal = np.einsum("nii->ni", a)
    flat = diagonal <= 1e-9 * np.maximum(scale, 1)
    keep = ~flat
    a = a * keep[:, :, None] * keep[:, None, :]
    size = np.where(keep, diagonal, 1.0)
    a = a + np.eye(a.shape[1]) * np.where(flat, 1.0, RIDGE * size)[:, :, None]
    return np.linalg.solve(a, (b * keep)[:, :, None])[:, :, 0]


def regression_slopes(moments: pd.Series) -> pd.Series:
    """Slopes of the last column on the others."""
    n, mean, cross = unpack(moments)
    # Rounding leaves a trace of variation in a constant column; measure against its size.
    scale = n[:, None] * np.maximum(mean[:, :-1] ** 2, 1)
    return pd.Series(list(solve_spd(cross[:, :-1, :-1], cross[:, :-1, -1], scale)))


def yule_walker(autocovariances: pd.Series) -> pd.Series:
    """Autoregressive coefficients from autocovariances at lags 0, 1, ..., order."""
    g = np.stack([np.nan_to_num(np.asarray(row, dtype=float)) for row in autocovariances])
    order = g.shape[1] - 1
    distance = np.abs(np.subtract.outer(np.arange(order), np.arange(order)))
    return pd.Series(list(solve_spd(g[:, distance], g[:, 1:], np.ones((len(g), 1)))))


def largest_root(coefficients: np.ndarray) -> np.ndarray:
    """Largest modulus of the companion matrix's eigenvalues, per group."""
    n, k = coefficients.shape
    if k == 0:
        return np.zeros(n)
    companion = np.zeros((n, k, k))
    companion[:, 0, :] = coefficients
    companion[:, np.arange(1, k), np.arange(k - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1)


def choose_arma(moments: pd.Series, newest: pd.Series, last_z: pd.Series,
                mean_v: pd.Series, d: pd.Series, max_order: int, horizon: int
                ) -> pd.DataFrame:
    """Best ARMA(p, q) by AIC with p + q <= max_order, and its forecasts. ``newest`` has
    the last values, newest first, followed by the last residuals."""
    k = max_order
    n, mean, cross = unpack(moments)
    total = cross[:, -1, -1]
    groups = len(n)
    best = {"aic": np.full(groups, np.inf), "p": np.zeros(groups, int),
            "q": np.zeros(groups, int), "coef": np.zeros((groups, 2 * k)),
            "sse": np.maximum(total, 0.0)}
    ones = np.ones((groups, 1))
    for p in range(k + 1):
        for q in range(k + 1 - p):
            use = [*range(p), *range(k, k + q)]
            coef = np.zeros((groups, 2 * k))
            if use:
                coef[:, use] = solve_spd(cross[:, use][:, :, use], cross[:, use, -1], ones)
            sse = (total - 2 * np.einsum("ni,ni->n", coef, cross[:, :-1, -1])
                   + np.einsum("ni,nij,nj->n", coef, cross[:, :-1, :-1], coef))
            sse = np.maximum(sse, 0.0)
            aic = n * np.log(np.maximum(sse / np.maximum(n, 1), 1e-12)) + 2 * (p + q + 1)
            stable = (largest_root(coef[:, :p]) < 0.99) & (largest_root(-coef[:, k:k + q]) < 0.99)
            usable = (stable & (n > 2 * (p + q + 1))) if use else np.ones(groups, bool)
            better = usable & (aic < best["aic"])
            for name, value in (("aic", aic), ("sse", sse), ("coef", coef)):
                best[name][better] = value[better]
            best["p"][better], best["q"][better] = p, q
    coef, variance = best["coef"], best["sse"] / np.maximum(n, 1)
    ar, ma = coef[:, :k], coef[:, k:]
    intercept = mean[:, -1] - (coef * mean[:, :-1]).sum(axis=1)
    integrated = d.to_numpy() == 1

    recent = np.nan_to_num(np.stack(newest).astype(float))
    v, e = recent[:, :k], recent[:, k:]
    steps, psi = np.zeros((groups, horizon)), np.zeros((groups, horizon))
    for h in range(horizon):
        steps[:, h] = intercept + (ar * v).sum(axis=1) + (ma * e).sum(axis=1)
        v = np.column_stack([steps[:, h], v[:, :-1]])
        e = np.column_stack([np.zeros(groups), e[:, :-1]])
        psi[:, h] = 1.0 if h == 0 else (ma[:, h - 1] if h <= k else 0.0) + sum(
            ar[:, i] * psi[:, h - 1 - i] for i in range(min(k, h)))
    # Values were taken around their mean; without any difference, the last value stands.
    steps += np.nan_to_num(mean_v.to_numpy(dtype=float))[:, None]
    level = np.where(integrated[:, None], last_z.to_numpy()[:, None] + steps.cumsum(axis=1), steps)
    psi = np.where(integrated[:, None], psi.cumsum(axis=1), psi)
    error = np.sqrt(variance[:, None] * (psi ** 2).cumsum(axis=1))
    return pd.DataFrame({
        "p": best["p"], "q": best["q"],
        "ar": [ar[i, :p] for i, p in enumerate(best["p"])],
        "ma": [ma[i, :q] for i, q in enumerate(best["q"])],
        "intercept": intercept + np.nan_to_num(mean_v.to_numpy(dtype=float))
        * (1 - ar.sum(axis=1)), "variance": variance, "aic": best["aic"],
        "mean": list(level), "error": list(error)})


def long_run_variance(y: np.ndarray) -> float:
    """Variance of a mean's increments over n, from robust spreads of first and second
    differences, which a few steps in the level do not move."""
    spreads = []
    for lag in (1, 2):
        d = y[lag:] - y[:-lag]
        middle = 1.4826 * np.median(np.abs(d - np.median(d)))
        spreads.append(middle ** 2 if middle > 1e-9 else float(np.var(d)))
    if spreads[0] <= 1e-18:
        return 0.0
    # First differences of an AR(1) have 2 s (1 - r), those two apart 2 s (1 - r^2).
    r = min(max(spreads[1] / spreads[0] - 1, 0.0), 0.9)
    return spreads[0] / (2 * (1 - r)) * (1 + r) / (1 - r)


def change_points(batch: list[np.ndarray], least: int, costs: np.ndarray) -> list[np.ndarray]:
    """Where each series' segments begin, in the partition that minimises the squared errors
    around segment means plus a cost per segment; no segment is shorter than ``least``.

    One dynamic program runs over a whole batch, last period by last period. A start that is
    already worse than a cut at the period in hand can be the last start of no later optimum;
    once it is so in every series, its column goes.
    """
    size = np.array([len(y) for y in batch])
    n = int(size.max(initial=0))
    padded = np.stack([np.pad(y, (0, n - len(y))) for y in batch]) if n else np.zeros((len(batch), 0))
    edge = np.zeros((len(batch), 1))
    s1 = np.hstack([edge, np.cumsum(padded, axis=1)])
    s2 = np.hstack([edge, np.cumsum(padded ** 2, axis=1)])
    best = np.full((len(batch), n + 1), np.inf)
    best[:, 0] = 0.0
    came = np.zeros((len(batch), n + 1), dtype=int)
    starts = np.zeros(0, dtype=int)
    gone = np.zeros((len(batch), 0), dtype=int)
    for end in range(least, n + 1):
        if end == least or end - least >= least:
            starts = np.append(starts, end - least)
            gone = np.hstack([gone, np.full((len(batch), 1), n + 1)])
        total = s1[:, [end]] - s1[:, starts]
        error = np.maximum(s2[:, [end]] - s2[:, starts] - total ** 2 / (end - starts), 0.0)
        reach = best[:, starts] + error
        pick = reach.argmin(axis=1)
        rows = np.arange(len(batch))
        best[:, end] = reach[rows, pick] + costs
        came[:, end] = starts[pick]
        # A start that is worse than a segment ending here is so from the first end on that
        # leaves room for a segment after it.
        worse = reach > best[:, [end]] + 1e-9 * (1 + np.abs(best[:, [end]]))
        gone = np.minimum(gone, np.where(worse, end + least, n + 1))
        gone[size <= end] = 0
        keep = (gone > end + 1).any(axis=0)
        starts, gone = starts[keep], gone[:, keep]
        if (size <= end).all():
            break
    found = []
    for i, last in enumerate(size):
        cuts, at = [], int(last) if last >= least else 0
        while at:
            at = int(came[i, at])
            cuts.append(at)
        found.append(np.array(cuts[::-1] or [0], dtype=int))
    return found


def step_levels(values: pd.Series, least: int, penalty: float) -> pd.Series:
    """For each array, its segments' means less the last one's; NaN stays out and gets 0."""
    out, arrays, known = [], [], []
    for row in values:
        y = np.asarray([] if row is None else row, dtype=float)
        out.append(np.zeros(len(y)))
        known.append(~np.isnan(y))
        arrays.append(y[known[-1]])
    # Series of like length share a dynamic program, so that little of it is padding.
    order = sorted(range(len(arrays)), key=lambda i: len(arrays[i]))
    for at in range(0, len(order), 256):
        part = [i for i in order[at:at + 256] if len(arrays[i]) >= 2 * least]
        spread = np.array([long_run_variance(arrays[i]) for i in part])
        costs = penalty * spread * np.log([max(len(arrays[i]), 2) for i in part])
        # Without any spread every wiggle would be a step.
        costs = np.where(costs > 0, costs, np.inf)
        live = [k for k in range(len(part)) if np.isfinite(costs[k])]
        cuts = change_points([arrays[part[k]] for k in live], least, costs[live])
        for k, begins in zip(live, cuts, strict=True):
            y = arrays[part[k]]
            ends = np.append(begins[1:], len(y))
            means = np.array([y[a:b].mean() for a, b in zip(begins, ends, strict=True)])
            level = np.repeat(means - means[-1], ends - begins)
            out[part[k]][known[part[k]]] = level
    return pd.Series(out, index=values.index)
