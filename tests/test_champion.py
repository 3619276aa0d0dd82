"""The paired test of two models' losses against plain numpy."""

import datetime as dt

import numpy as np
import pytest

from foldcast.operators import report

DAY = dt.date(2020, 1, 6)


def board(spark, **models):
    rows = [(name, DAY + dt.timedelta(days=7 * t), s, None if v is None else float(v) / 2)
            for name, losses in models.items() for t, v in enumerate(losses) for s in "ab"]
    return spark.createDataFrame(rows, "model_name string, period date, series string, wAbsError double")


def newey_west(d, lags):
    e, n = d - d.mean(), len(d)
    total = e @ e + sum(2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return np.sqrt(total) / n


@pytest.mark.parametrize("lags", [0, 1, 6])
def test_statistic_equals_numpy(spark, lags):
    rng = np.random.default_rng(4)
    old, noise = rng.gamma(3, 10, 80), rng.normal(size=83)
    close = old + noise[:80] + noise[1:81] + noise[2:82]
    rows = report.champion_test(board(spark, old=old, close=close, good=old * 0.6, bad=old * 1.5), "old", lags)
    found = {r.challenger: r for r in rows.collect()}
    for name, losses in (("close", close), ("good", old * 0.6), ("bad", old * 1.5)):
        d = old - losses
        assert found[name].mean_difference == pytest.approx(d.mean())
        assert found[name].standard_error == pytest.approx(newey_west(d, lags))
        assert found[name].statistic == pytest.approx(d.mean() / newey_west(d, lags))
    assert (found["good"].decision, found["bad"].decision) == ("challenger", "champion")


def test_edges(spark):
    rows = board(spark, old=[5, 5, 5, 5], same=[5, 5, 5, 5], less=[4, 4, 4, 4], some=[4, None])
    found = {r.challenger: r for r in report.champion_test(rows, "old", 2).collect()}
    assert (found["same"].statistic, found["same"].decision) == (None, "champion")
    assert (found["less"].statistic, found["less"].decision) == (None, "challenger")
    assert found["some"].n_periods == 2 and found["some"].mean_difference == pytest.approx(3.0)
    assert report.champion_test(rows, "unknown", 2).count() == 0
    assert report.champion_test(rows.where("false"), "old", 2).count() == 0
