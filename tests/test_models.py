import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast.functions import kernels
from foldcast.operators import arima, auto_arima, pooled, xreg
from foldcast.operators import panel as P
from foldcast.operators.folds import Rolling
from foldcast.plans import backtest

D = dt.date
START = D(2018, 1, 1)
ROLLING = Rolling("2018-01-01", "2020-11-30", "2021-01-25", horizon=4, step=8)  # two folds


def panel_of(spark, **series):
    rows = [(name, START + dt.timedelta(days=7 * i), float(v))
            for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, period date, qty double")


def ar1(phi, n=170, mean=20.0, seed=1):
    rng, z = np.random.default_rng(seed), [0.0]
    for _ in range(n - 1):
        z.append(phi * z[-1] + rng.normal())
    return np.array(z) + mean


def test_constant_series_is_forecast_exactly(spark):
    fitted = arima.fit(arima.fold_grid(panel_of(spark, a=[7.0] * 170), ROLLING))
    rows = arima.forecast(fitted).collect()
    assert len(rows) == 2 * 4
    for r in rows:
        assert r.forecast_value == pytest.approx(7.0)
        assert r.prediction_interval_upper_bound == pytest.approx(7.0)
    models = arima.coefficients(fitted).collect()
    assert {(m.p, m.d, m.q) for m in models} == {(0, 0, 0)}


def test_short_series_and_cold_starts(spark):
    panel = panel_of(spark, one=[3.0]).unionByName(
        panel_of(spark, late=[5.0] * 170).filter("period >= '2020-12-21'"))
    fitted = arima.fit(arima.fold_grid(panel, ROLLING, fill="none"))
    rows = arima.forecast(fitted).collect()
    assert {(r.fold, r.series) for r in rows} == {(0, "one"), (1, "one"), (1, "late")}
    assert all(r.forecast_value == pytest.approx(3.0 if r.series == "one" else 5.0)
               for r in rows)


@pytest.mark.parametrize("max_order", [1, 5])
def test_forecasts_may_start_at_the_series_end(spark, max_order):
    # Silent for five weeks before a four-week horizon from the first fold's test start.
    end = D(2020, 11, 30) - dt.timedelta(days=7 * 5)
    near = D(2020, 11, 30) - dt.timedelta(days=7 * 2)
    panel = panel_of(spark, far=[5.0] * 170).filter(F.col("period") < F.lit(end)).unionByName(
        panel_of(spark, near=[5.0] * 170).filter(F.col("period") < F.lit(near)))
    rows = backtest.arima_forecasts(panel, ROLLING, max_order=max_order, origin="series_end")
    ahead = rows.filter("fold = 0 AND time_series_type = 'forecast'").collect()
    got = {s: sorted(r.period for r in ahead if r.series == s) for s in ("far", "near")}
    assert got["far"] == [end + dt.timedelta(days=7 * h) for h in range(4)]
    assert got["near"] == [near + dt.timedelta(days=7 * h) for h in range(4)]
    assert all(r.forecast_value == pytest.approx(5.0) for r in ahead)
    # By default forecasts cover the test range, and silence counts as zeros.
    default = backtest.arima_forecasts(panel, ROLLING, max_order=max_order)
    dates = default.filter("fold = 0 AND time_series_type = 'forecast' AND series = 'far'")
    assert sorted(r.period for r in dates.collect()) == [
        D(2020, 11, 30) + dt.timedelta(days=7 * h) for h in range(4)]


def test_no_row_after_the_test_start_matters(spark):
    values = ar1(0.6)
    changed = values.copy()
    first_test = (D(2020, 11, 30) - START).days // 7
    changed[first_test:] = 1000.0
    for model in (1, 5):
        got = []
        for v in (values, changed):
            fc = backtest.arima_forecasts(panel_of(spark, a=v), ROLLING, max_order=model)
            fc = fc.filter("fold = 0 AND time_series_type = 'forecast'").orderBy("period")
            got.append([r.forecast_value for r in fc.collect()])
        assert len(got[0]) == 4 and got[0] == pytest.approx(got[1])


def test_autoregression_agrees_across_solvers(spark):
    """The order search restricted to p <= 1 lands near the closed-form estimate."""
    panel = panel_of(spark, a=ar1(0.7, seed=2)[:100])
    one = Rolling("2018-01-01", "2019-11-04", "2019-11-04", horizon=4)
    grid = arima.fold_grid(panel, one)
    closed = arima.coefficients(arima.fit(grid)).collect()[0]
    searched = auto_arima.coefficients(auto_arima.fit(grid, 4, max_order=1)).collect()[0]
    assert (closed.p, closed.d) == (1, 0) and searched.p == 1
    assert searched.ar_coefficients[0] == pytest.approx(closed.ar_coefficients[0], abs=0.1)
    a = arima.forecast(arima.fit(grid)).orderBy("period").collect()
    b = auto_arima.forecast(auto_arima.fit(grid, 4, max_order=1)).orderBy("period").collect()
    assert [r.period for r in a] == [r.period for r in b]
    assert [r.forecast_value for r in a] == pytest.approx(
        [r.forecast_value for r in b], abs=0.5)


def test_trending_series_is_differenced(spark):
    fitted = arima.fit(arima.fold_grid(panel_of(spark, a=np.arange(100) * 3.0), Rolling(
        "2018-01-01", "2019-11-04", "2019-11-04", horizon=4), fill="none"))
    model = arima.coefficients(fitted).collect()[0]
    assert model.d == 1 and model.intercept_or_drift == pytest.approx(3.0)
    got = [r.forecast_value for r in arima.forecast(fitted).orderBy("period").collect()]
    n = (D(2019, 11, 4) - START).days // 7
    assert got == pytest.approx([3.0 * (n + h) for h in range(4)])


def test_limits_and_other_intervals(spark):
    grid = arima.fold_grid(panel_of(spark, a=ar1(0.5)), ROLLING)
    fitted = arima.fit(grid)
    limited = arima.forecast(fitted, lower=19.5, upper=20.5).collect()
    assert all(19.5 <= v <= 20.5 for r in limited for v in (
        r.forecast_value, r.prediction_interval_lower_bound,
        r.prediction_interval_upper_bound))
    direct = arima.explain(fitted, 0.9).filter("time_series_type = 'forecast'")
    derived = arima.with_interval(arima.explain(fitted, 0.95), 0.9).filter(
        "time_series_type = 'forecast'")
    a = [r.prediction_interval_upper_bound for r in direct.orderBy("fold", "period").collect()]
    b = [r.prediction_interval_upper_bound for r in derived.orderBy("fold", "period").collect()]
    assert a == pytest.approx(b)


def test_regression_on_several_covariates(spark):
    rng = np.random.default_rng(4)
    n = 176
    x = rng.normal(size=(n, 2))
    y = 100 + 5 * x[:, 0] - 3 * x[:, 1] + rng.normal(0, 0.1, n)
    calendar = spark.createDataFrame(
        [(START + dt.timedelta(days=7 * i), float(a), float(b)) for i, (a, b) in enumerate(x)],
        "period date, x1 double, x2 double")
    panel = panel_of(spark, a=y).withColumn("station", F.lit(17))
    grid = arima.fold_grid(panel, ROLLING, calendar, ["x1", "x2"], attributes=["station"])
    used = xreg.remove_many(grid, ["x1", "x2", "station"])
    for fold, start in ((0, D(2020, 11, 30)), (1, D(2021, 1, 25))):
        m = (start - START).days // 7
        design = np.column_stack([np.ones(m), x[:m]])
        beta = np.linalg.lstsq(design, y[:m], rcond=None)[0]
        rows = used.filter(F.col("fold") == fold).orderBy("period").collect()
        expected = [beta[1] * a + beta[2] * b for a, b in x[:len(rows)]]
        assert [r.regressor for r in rows] == pytest.approx(expected, abs=1e-5)
    explained = arima.explain(arima.fit(used)).filter("time_series_type = 'forecast'")
    for r in explained.collect():
        i = (r.period - START).days // 7
        assert r.forecast_value == pytest.approx(y[i], abs=3.0)
        assert r.forecast_value == pytest.approx(
            r.trend + r.seasonal + r.holiday_effect + r.regressor_effect)


def test_kernels():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50, 3))
    y = x @ [1.0, -2.0, 0.5] + 4 + rng.normal(0, 0.01, 50)
    cols = np.column_stack([x, y])
    i, j = np.triu_indices(4)
    moments = np.concatenate([[50], cols.sum(0), (cols[:, i] * cols[:, j]).sum(0)])
    slopes = kernels.regression_slopes(pd.Series([moments]))[0]
    expected = np.linalg.lstsq(np.column_stack([np.ones(50), x]), y, rcond=None)[0][1:]
    assert slopes == pytest.approx(expected)
    # Autocovariances of an AR(2) with coefficients 0.5 and 0.3.
    rho = [1.0, 0.5 / 0.7]
    for k in range(2, 6):
        rho.append(0.5 * rho[k - 1] + 0.3 * rho[k - 2])
    assert kernels.yule_walker(pd.Series([rho]))[0] == pytest.approx(
        [0.5, 0.3, 0, 0, 0], abs=1e-8)
    assert kernels.largest_root(np.array([[0.5, 0.3], [1.0, 0.0]])) == pytest.approx(
        [(0.5 + np.sqrt(0.25 + 1.2)) / 2, 1.0])


def test_moving_average_is_recognised(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=100)
    y = 50 + e + 0.8 * np.concatenate([[0], e[:-1]])
    one = Rolling("2018-01-01", "2019-11-04", "2019-11-04", horizon=4)
    models = auto_arima.fit(arima.fold_grid(panel_of(spark, a=y), one), 4)
    model = auto_arima.coefficients(models).collect()[0]
    assert model.d == 0 and 1 <= model.p + model.q <= 5
    rows = auto_arima.forecast(models).orderBy("period").collect()
    assert [r.forecast_value for r in rows] == pytest.approx([50] * 4, abs=3.0)
    widths = [r.standard_error for r in rows]
    assert widths == sorted(widths)


def test_window_examples_do_not_leak(spark):
    panel = panel_of(spark, a=range(30)).withColumn("stock", F.col("qty") * 10)
    rows = pooled.window_examples(panel, 3, 2, unknown=["stock"]).collect()
    assert len(rows) == 28 * 2
    for r in rows:
        at = (r.origin - START).days // 7
        assert (r.lag_1, r.lag_2, r.lag_3) == (at, at - 1, at - 2)
        assert r.stock_at_origin == at * 10
        assert (r.period - r.origin).days == 7 * r.h
        assert r.target == (at + r.h if at + r.h < 30 else None)


@pytest.mark.parametrize("kind", ["learn_to_learn", "dense_encoder"])
def test_pooled_backtest(spark, kind):
    season = 20 + 5 * np.sin(np.arange(170) * 2 * np.pi / 8)
    panel = P.fill_gaps(panel_of(spark, a=season, b=season * 2).withColumn(
        "qty", F.round("qty").cast("bigint"))).withColumn("kind", F.lit("dock"))
    result = backtest.pooled_backtest(panel, ROLLING, "r", kind, context=10,
                                      attributes=["kind"], carry=["kind"])
    assert result.forecasts.count() == 2 * 2 * 4
    assert {r.kind for r in result.dashboard.collect()} == {"dock"}
    for r in result.metrics.collect():
        assert r.wMAPE < 20
    logged = result.log.orderBy("run_name").collect()
    assert [r.run_name for r in logged] == ["r-fold-0", "r-fold-1"]
    assert set(logged[0].metrics) == {"wMAPE", "MAPE", "MAE", "pMAE", "MSE", "RMSE", "pRMSE"}


def test_unknown_pooled_model_fails_first(spark):
    with pytest.raises(ValueError):
        pooled.fit_and_forecast(panel_of(spark, a=[1.0]), ROLLING, "other")


def test_arima_backtest_and_publish(spark, tmp_path):
    panel = panel_of(spark, a=ar1(0.5), b=ar1(0.2, seed=9)).withColumn(
        "qty", F.round("qty").cast("bigint"))
    result = backtest.arima_backtest(panel, ROLLING, "r1", lower=0.0, max_order=1,
                                     holiday_regions=["GLOBAL", "US"])
    backtest.publish(result, str(tmp_path))
    backtest.publish(result, str(tmp_path))
    board = spark.read.parquet(f"{tmp_path}/dashboard")
    assert board.count() == 2 * 2 * (2 * 5)  # twice: folds x (series x five dates)
    runs = spark.read.parquet(f"{tmp_path}/runs").collect()
    assert len(runs) == 4 and all(r.metrics["Global_wMAPE"] < 30 for r in runs)
    stored = spark.read.parquet(f"{tmp_path}/evaluation")
    assert stored.count() == result.evaluation.count() == panel.count() * 2


@pytest.mark.parametrize("options", [
    {"max_order": 1}, {"max_order": 2}, {"max_order": 1, "origin": "series_end"}])
def test_daily_horizons_count_days(spark, options):
    days = [(name, START + dt.timedelta(days=i), float(10 + i % 7))
            for name in "ab" for i in range(120)]
    panel = spark.createDataFrame(days, "series string, period date, qty double")
    one = Rolling("2018-01-01", "2018-05-01", "2018-05-01", horizon=2)
    rows = backtest.arima_forecasts(panel, one, granularity="DAILY", **options)
    assert rows.columns == arima.explain(arima.fit(arima.fold_grid(panel, one))).columns
    ahead = rows.filter("time_series_type = 'forecast'")
    assert ahead.select("series", "period").distinct().count() == ahead.count() == 28
    assert rows.filter("time_series_type = 'history'").count() == 240
    assert ahead.filter("forecast_value IS NULL OR standard_error IS NULL").count() == 0


def test_automatic_explanation_adds_up(spark):
    rows = backtest.arima_forecasts(panel_of(spark, a=ar1(0.7)), ROLLING, max_order=2)
    parts = F.col("trend") + F.col("seasonal") + F.col("holiday_effect") + F.col("regressor_effect")
    known = rows.filter("forecast_value IS NOT NULL")
    assert known.filter(F.abs(parts - F.col("forecast_value")) > 1e-9).count() == 0
    fitted = known.filter("time_series_type = 'history'")
    error = fitted.agg(F.stddev(F.col("time_series_data") - F.col("forecast_value"))).first()[0]
    assert error < fitted.agg(F.stddev("time_series_data")).first()[0]
    grid = arima.fold_grid(panel_of(spark, a=ar1(0.7)), ROLLING)
    info = auto_arima.training_info(auto_arima.fit(grid, 4, max_order=2)).collect()
    assert len(info) == 2 and all(sum(r.orders.values()) == r.n_series == 1 for r in info)


def test_covariates_of_each_series_and_period(spark):
    rng = np.random.default_rng(5)
    rows = [(name, START + dt.timedelta(days=7 * i), 50.0 - 3.0 * price, price)
            for name in "ab" for i in range(170) for price in [float(rng.integers(1, 9))]]
    panel = spark.createDataFrame(rows, "series string, period date, qty double, price double")
    got = backtest.arima_forecasts(panel, ROLLING, max_order=1, series_covariates=["price"])
    ahead = got.filter("time_series_type = 'forecast'").join(
        panel.select("series", "period", F.col("qty").alias("truth")), ["series", "period"])
    assert ahead.count() > 0
    assert ahead.agg(F.max(F.abs(F.col("forecast_value") - F.col("truth")))).first()[0] < 0.2


def test_unknown_covariates_keep_lags_regular(spark):
    full = panel_of(spark, a=range(60), b=range(60)).withColumn("seen", F.col("qty") * 2)
    sparse = full.filter("qty % 7 != 3")
    filled = P.fill_gaps(sparse, varying_cols=["seen"])
    rows = pooled.window_examples(filled, 4, 2, unknown=["seen"]).collect()
    by_origin = {(r.series, r.origin, r.h): r for r in rows}
    for r in rows:
        i = (r.origin - START).days // 7
        assert r.lag_2 == (0 if (i - 1) % 7 == 3 else i - 1)
        assert r.seen_at_origin == (None if i % 7 == 3 else 2 * i)
    assert len(by_origin) == len(rows)


def test_evaluation_is_kept_per_run_and_model(spark, tmp_path):
    panel = panel_of(spark, a=ar1(0.5))
    for run, model in (("r1", "arima"), ("r1", "other"), ("r2", "arima"), ("r2", "arima")):
        result = backtest.arima_backtest(panel, ROLLING, run, model, max_order=1)
        backtest.publish(result, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/evaluation")
    counts = {(r.run_id, r.model_name): r["count"]
              for r in stored.groupBy("run_id", "model_name").count().collect()}
    assert set(counts) == {("r1", "arima"), ("r1", "other"), ("r2", "arima")}
    assert len(set(counts.values())) == 1


def test_fan_out_uses_the_sessions_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "77")
        assert P.spread(panel_of(spark, a=[1.0]), "series").rdd.getNumPartitions() == 77
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_automatic_arima_reports_cover_the_weekly_panels_series(spark):
    from foldcast.plans.queries import QUERIES
    from foldcast.sources import bindings as B
    sf = "/root/testdata/sf0.001"
    series = {r.series for r in B.core_panel(spark, sf).select("series").distinct().collect()}
    explained = {r.series for r in QUERIES["arima_auto_explain"](spark, sf)
                 .select("series").distinct().collect()}
    assert explained <= series and len(explained) > 25
    info = QUERIES["arima_auto_training_info"](spark, sf)
    assert info.agg(F.max("n_series")).first()[0] > 25
