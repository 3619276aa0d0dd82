"""Spikes, dips and step changes: kernels against exhaustive search, operators on small panels."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast.functions import kernels
from foldcast.operators import adjust, arima, auto_arima
from foldcast.operators.folds import Rolling


def exhaustive(y, least, cost):
    """The best partition by trying every one."""
    n, best = len(y), (np.inf, None)
    for k in range(n // least):
        for cuts in itertools.combinations(range(least, n - least + 1), k):
            edges = [0, *cuts, n]
            if min(b - a for a, b in zip(edges[:-1], edges[1:])) < least:
                continue
            error = sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in zip(edges[:-1], edges[1:]))
            best = min(best, (error + cost * (k + 1), edges[:-1]))
    return best[1]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_change_points_are_those_of_exhaustive_search(least):
    random = np.random.default_rng(least)
    batch, costs = [], []
    for k in range(60):
        n = int(random.integers(max(2 * least, 2), 11))
        batch.append(random.normal(size=n) + np.repeat(random.normal(scale=3, size=n), 4)[:n] * (k % 2))
        costs.append(random.uniform(0.2, 6))
    found = kernels.change_points(batch, least, np.array(costs))
    for y, cost, cuts in zip(batch, costs, found, strict=True):
        assert list(cuts) == exhaustive(y, least, cost)


def test_pruning_keeps_the_optimum_of_long_series():
    random = np.random.default_rng(7)
    batch = [random.normal(size=n) + np.repeat(random.normal(scale=4, size=8), 40)[:n] for n in (150, 300, 301)]
    cost = np.array([8.0, 12.0, 20.0])
    found = kernels.change_points(batch, 8, cost)
    for y, c, cuts in zip(batch, cost, found, strict=True):
        best, came = [0.0] + [np.inf] * len(y), [0] * (len(y) + 1)
        for end in range(8, len(y) + 1):
            for start in [0, *range(8, end - 7)]:
                total = best[start] + ((y[start:end] - y[start:end].mean()) ** 2).sum() + c
                if total < best[end] - 1e-9:
                    best[end], came[end] = total, start
        want, at = [], len(y)
        while at:
            at = came[at]
            want.append(at)
        assert list(cuts) == want[::-1]


def test_step_levels():
    noise = np.random.default_rng(1).normal(size=120)
    stepped = np.concatenate([noise[:60], noise[60:] + 20])
    rows = pd.Series([stepped, noise, [1.0, None, 2.0], [], None, [3.0] * 40,
                      np.insert(stepped, 30, [np.nan] * 5)])
    found = kernels.step_levels(rows, 8, 3.0)
    assert [len(x) for x in found] == [120, 120, 3, 0, 0, 40, 125]
    assert np.allclose(found[0][:60], noise[:60].mean() - noise[60:].mean() - 20) and not found[0][60:].any()
    assert not found[1].any() and not found[2].any() and not found[5].any()
    assert not found[6][30:35].any() and np.allclose(np.delete(found[6], range(30, 35)), found[0])


def test_a_random_walk_is_not_cut_to_pieces():
    walk = np.random.default_rng(3).normal(size=300).cumsum()
    level = kernels.step_levels(pd.Series([walk]), 8, 3.0)[0]
    assert len(np.unique(level)) <= 8


@pytest.fixture(scope="module")
def panel(spark):
    random = np.random.default_rng(5)
    rows = []
    for name in "ab":
        for t, day in enumerate(pd.date_range("2019-01-07", periods=103, freq="7D")):
            y = 100 + random.normal() + (30 if name == "b" and t >= 50 else 0)
            y += {20: 60, 75: -50}.get(t, 0)
            rows.append((name, day.date(), float(round(y, 3))))
    rows.append(("short", rows[0][1], 5.0))
    return spark.createDataFrame(rows, "series string, period date, qty double")


ROLLING = Rolling("2019-01-07", "2020-11-30", "2020-12-21", horizon=2)


def test_spikes_and_dips_are_found_once_each(panel):
    rows = arima.remove_effects(arima.fold_grid(panel, ROLLING))
    found = adjust.spikes_and_dips(rows, ["series", "fold"], "period").filter("spikes_and_dips <> 0")
    got = {(r.series, r.t): r.spikes_and_dips for r in found.filter("fold = 0").collect()}
    for name in "ab":
        assert abs(got[name, 21] - 60) < 5 and abs(got[name, 76] + 50) < 5
    assert len(got) <= 8


@pytest.mark.parametrize("model", ["closed", "automatic"])
def test_explanation_tells_what_was_adjusted(panel, model):
    grid = arima.fold_grid(panel, ROLLING)
    if model == "closed":
        plain, found = (arima.explain(arima.fit(grid, adjusted=x)) for x in (False, True))
    else:
        plain, found = (auto_arima.explain(grid, 2, 2, 4, adjusted=x) for x in (False, True))
    assert found.columns == [*plain.columns, *adjust.COLUMNS]
    rows = found.toPandas()
    assert len(rows) == plain.count()
    assert not rows[list(adjust.COLUMNS)].isna().any().any()
    ahead = rows[rows.time_series_type == "forecast"]
    assert (ahead.adjusted_data == ahead.forecast_value).all()
    assert not ahead[["spikes_and_dips", "step_changes"]].any().any()
    past = rows[rows.time_series_type == "history"]
    assert np.allclose(past.adjusted_data, past.time_series_data - past.spikes_and_dips - past.step_changes)
    b = past[(past.series == "b") & (past.fold == 0)].sort_values("period")
    assert np.allclose(b.step_changes[:45], -30, atol=3) and not b.step_changes[-45:].any()
    # forecasts start at the level after the step
    assert ahead[ahead.series == "b"].forecast_value.between(120, 140).all()


def test_adjusting_shuffles_once(panel):
    rows = arima.remove_effects(arima.fold_grid(panel, ROLLING))
    plain, adjusted = (x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                       for x in (rows, adjust.adjust(rows, ["series", "fold"])))
    assert adjusted <= plain + 1
    assert adjust.adjust(rows.filter(F.lit(False)), ["series", "fold"]).count() == 0
