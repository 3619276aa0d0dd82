import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldcast.operators import decompose, holiday, lowess

D = dt.date


def weekly(spark, values, series="a"):
    rows = [(series, D(2018, 1, 1) + dt.timedelta(days=7 * i), float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, period date, qty double")


@pytest.mark.parametrize("model", ["multiplicative", "additive"])
def test_decomposition_recomposes(spark, model):
    rng = np.random.default_rng(3)
    y = 50 + 10 * np.sin(np.arange(200) * 2 * np.pi / 52) + rng.normal(0, 1, 200)
    rows = decompose.seasonal_decompose(weekly(spark, y), model=model).orderBy("period").collect()
    trend = np.array([np.nan if r.trend is None else r.trend for r in rows])
    assert np.isnan(trend[:26]).all() and np.isnan(trend[-26:]).all()
    expected = [(y[i - 26] / 2 + y[i - 25:i + 26].sum() + y[i + 26] / 2) / 52
                for i in range(26, 174)]
    assert trend[26:174] == pytest.approx(expected)
    season = np.array([r.seasonal for r in rows])
    assert season[:52] == pytest.approx(season[52:104])
    neutral = season[:52].mean()
    assert neutral == pytest.approx(1.0 if model == "multiplicative" else 0.0, abs=1e-9)
    for r in rows[26:174]:
        whole = (r.trend * r.seasonal * r.resid if model == "multiplicative"
                 else r.trend + r.seasonal + r.resid)
        assert whole == pytest.approx(r.qty)


def test_unknown_decomposition_is_an_error(spark):
    with pytest.raises(ValueError):
        decompose.seasonal_decompose(weekly(spark, [1.0]), model="other")


def test_short_series_has_no_trend(spark):
    rows = decompose.seasonal_decompose(weekly(spark, range(40))).collect()
    assert all(r.trend is None and r.seasonal is None for r in rows)


def smooth_by_hand(x, y, frac, iters):
    """Plain LOWESS over a few points."""
    n = len(x)
    k = max(int(frac * n + 1e-10), 1)
    robust, fit = np.ones(n), np.array(y, dtype=float)
    for i in range(iters + 1):
        for j in range(n):
            d = np.abs(x - x[j])
            radius = np.sort(d)[k - 1]
            w = np.where(d < radius, (1 - (d / radius) ** 3) ** 3, 0.0) * robust
            if w.sum() > 0:
                w = w / w.sum()
                mx = (w * x).sum()
                sxx = max((w * (x - mx) ** 2).sum(), 1e-12)
                fit[j] = (w * (1 + (x[j] - mx) * (x - mx) / sxx) * y).sum()
        r = np.abs(y - fit)
        u = np.minimum(r / (6 * np.median(r)), 1.0)
        robust = (1 - u ** 2) ** 2
    return fit


@pytest.mark.parametrize("frac,iters", [(0.4, 0), (0.4, 3), (0.7, 2)])
def test_lowess_against_plain_loops(spark, frac, iters):
    rng = np.random.default_rng(5)
    x = np.sort(rng.choice(np.arange(1, 54), 31, replace=False)).astype(float)
    y = np.sin(x / 8) + rng.normal(0, 0.2, 31)
    y[7] += 4
    df = spark.createDataFrame([("a", int(a), float(b)) for a, b in zip(x, y)],
                               "series string, week_of_year int, seasonal double")
    rows = lowess.lowess(df, frac=frac, iters=iters).orderBy("week_of_year").collect()
    assert [r.week_of_year for r in rows] == list(x)
    assert [r.smoothed for r in rows] == pytest.approx(list(smooth_by_hand(x, y, frac, iters)))


def test_lowess_keeps_a_straight_line(spark):
    df = spark.createDataFrame([("a", i, 2.0 * i) for i in range(1, 54)],
                               "series string, week_of_year int, seasonal double")
    for r in lowess.lowess(df).collect():
        assert r.smoothed == pytest.approx(2.0 * r.week_of_year)


def test_holiday_rules(spark):
    rows = holiday.holiday_calendar(spark.range(1), "2000-01-01", "2024-12-31").collect()
    days = {(r.holiday, r.day.year): r.day for r in rows}
    assert days["Easter", 2000] == D(2000, 4, 23)
    assert days["Easter", 2011] == D(2011, 4, 24)
    assert days["Easter", 2024] == D(2024, 3, 31)
    assert days["Thanksgiving", 2024] == D(2024, 11, 28)
    assert days["Memorial Day", 2022] == D(2022, 5, 30)
    assert days["Memorial Day", 2021] == D(2021, 5, 31)
    assert days["Labor Day", 2024] == D(2024, 9, 2)
    assert days["Martin Luther King Day", 2018] == D(2018, 1, 15)
    assert all(r.period.weekday() == 0 and 0 <= (r.day - r.period).days < 7 for r in rows)
    world = holiday.holiday_calendar(spark.range(1), "2024-01-01", "2024-12-31", ["GLOBAL"])
    assert {r.holiday for r in world.collect()} == {"New Year", "Easter", "Christmas"}


def test_holiday_effect_is_the_ratio_to_the_trend(spark):
    df = weekly(spark, [10.0] * 200).withColumn("trend", F.lit(5.0))
    calendar = holiday.holiday_calendar(spark.range(1), "2018-01-01", "2020-12-31", ["GLOBAL"])
    got = {r.holiday: (r.holiday_effect, r.n_periods)
           for r in holiday.holiday_effects(df, calendar).collect()}
    assert got == {"New Year": (2.0, 3), "Easter": (2.0, 3), "Christmas": (2.0, 3)}
