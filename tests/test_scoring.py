import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from foldcast.functions import columns as C
from foldcast.operators import baseline, report, score
from foldcast.operators.folds import Rolling

D = dt.date
ONE = Rolling("2020-01-06", "2021-01-04", "2021-01-04", horizon=2)
PANEL = [("a", D(2021, 1, 4), 4), ("a", D(2021, 1, 11), 0), ("cold", D(2021, 1, 4), 2),
         ("a", D(2020, 1, 6), 3), ("a", D(2020, 12, 28), 5)]
FORECAST = [(0, "a", D(2021, 1, 4), "forecast", 6.0, 5.0, 7.0),
            (0, "a", D(2021, 1, 11), "forecast", -1.0, -2.0, 0.5),
            (0, "a", D(2020, 12, 28), "history", 4.0, None, None)]
FC_SCHEMA = ("fold int, series string, period date, time_series_type string, "
             "forecast_value double, prediction_interval_lower_bound double, "
             "prediction_interval_upper_bound double")


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(PANEL, "series string, period date, qty bigint")


@pytest.fixture(scope="module")
def forecasts(spark):
    return spark.createDataFrame(FORECAST, FC_SCHEMA)


def test_clamp(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (0.0,), (1.5,), (math.nan,)], "x double")
    got = [r.c for r in df.select(C.clamp("x").alias("c")).collect()]
    assert got[:4] == [0.0, 0.0, 0.0, 1.5] and math.isnan(got[4])


def test_cast_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",), ("-2.5",), ("2",)], "x string")
    assert [r.c for r in df.select(C.to_bigint("x").alias("c")).collect()] == [3, 4, -3, 2]


def test_lag_rounds_from_a_friday_start(spark):
    df = spark.createDataFrame([(D(2016, 1, 4),), (D(2016, 1, 11),)], "d date")
    lag = C.lag_index("d", F.lit("2016-01-01").cast("date"), "WEEKLY")
    assert [r[0] for r in df.select(lag).collect()] == [0.0, 1.0]
    daily = C.lag_index("d", F.lit("2016-01-01").cast("date"), "DAY")
    assert [r[0] for r in df.select(daily).collect()] == [3.0, 10.0]


def test_dashboard_rows(panel, forecasts):
    rows = score.dashboard_rows(panel, forecasts, ONE, "m", "run-7")
    got = {(r.series, r.period): r for r in rows.collect()}
    assert len(got) == 6  # two series, three dates with the end included
    hit = got["a", D(2021, 1, 4)]
    assert (hit.actualQty, hit.forecastQty, hit.diff, hit.wAbsError, hit.wHist) == (
        4, 6.0, -2.0, 8.0, 16)
    assert (hit.predicted_p10, hit.predicted_p90, hit.lag) == (5.0, 7.0, 0.0)
    assert (hit.run_id, hit.model_name, hit.fold) == ("run-7", "m", 0)
    negative = got["a", D(2021, 1, 11)]
    assert (negative.forecastQty, negative.predicted_p10, negative.diff) == (0.0, 0.0, 0.0)
    cold = got["cold", D(2021, 1, 4)]
    assert (cold.forecastQty, cold.diff, cold.wAbsError) == (0.0, 2.0, 4.0)
    assert "eval_timestamp" in score.dashboard_rows(
        panel, forecasts, ONE, "m", "r", timestamp=True).columns


def test_eval_rows_and_global_wmape(panel, forecasts):
    rows = score.eval_rows(panel, forecasts, ONE)
    got = {(r.a_series, r.period): r for r in rows.collect()}
    assert len(got) == len(PANEL)
    assert got["a", D(2021, 1, 4)].wMAPE == 50.0
    assert got["a", D(2021, 1, 11)].wMAPE is None  # no actual: nothing to divide by
    assert got["a", D(2020, 12, 28)].time_series_type == "history"
    assert got["a", D(2020, 1, 6)].forecast_value_filled == 0.0
    # The cold start counts only when asked for.
    assert score.global_wmape(rows).collect()[0].wMAPE == 8 * 100.0 / 16
    assert score.global_wmape(rows, with_cold_starts=True).collect()[0].wMAPE == (
        pytest.approx((8 + 4) * 100.0 / (16 + 4)))


def test_wmape_without_sales_is_null(spark):
    df = spark.createDataFrame([(0, 0.0, 0)], "fold int, wAbsError double, wHist bigint")
    assert score.dashboard_wmape(df).collect()[0].wMAPE is None


def items(spark):
    rows = [("a", D(2021, 1, 4), D(2021, 1, 4), "4", 6.0),
            ("a", D(2021, 1, 11), D(2021, 1, 11), "2.5", -1.0),
            ("a", D(2021, 1, 18), D(2021, 1, 18), "0", 2.0),
            ("a", D(2021, 1, 25), D(2021, 1, 25), "5", None),
            ("a", D(2021, 1, 4), D(2020, 12, 28), "4", 99.0)]
    df = spark.createDataFrame(
        rows, "series string, period date, predicted_on_period date, qty string, p double")
    return score.to_evaluated_items(df.withColumn("fold", F.lit(0)), "p")


def test_metric_suite_uses_raw_predictions(spark):
    errors = score.evaluated_errors(items(spark))
    assert errors.count() == 4  # the earlier prediction is dropped
    m = score.metric_suite(errors).collect()[0]
    # actuals 4, 3, 0, 5; errors -2, 4, -2, NULL
    assert m.wMAPE == pytest.approx((8 + 12 + 0) * 100 / (16 + 9 + 0 + 25))
    assert m.MAPE == pytest.approx((2 / 4 + 4 / 3) / 2)
    assert m.MAE == pytest.approx(8 / 3)
    assert m.pMAE == pytest.approx(8 / 12)
    assert m.MSE == pytest.approx(24 / 3)
    assert m.RMSE == pytest.approx(math.sqrt(8))
    assert m.pRMSE == pytest.approx(math.sqrt(8) / 3)


def test_metric_suite_clamped(spark):
    m = score.metric_suite(score.evaluated_errors(items(spark), clamp_errors=True)).collect()[0]
    # errors -2, 3, -2, 5
    assert m.MAE == pytest.approx(3.0)
    assert m.wMAPE == pytest.approx((8 + 9 + 0 + 25) * 100 / 50)


def test_evaluated_dashboard_rows_are_not_clamped(spark):
    name = C.global_model_name("dense_encoder", 20, "exp", C.fold_run_name("r1", "fold"))
    rows = score.evaluated_dashboard_rows(
        items(spark), name, "r1", F.lit("2021-01-04").cast("date")).orderBy("period").collect()
    assert rows[0].model_name == "tide_context20_exp_r1-fold-0" and rows[0].run_id == "r1"
    assert rows[1].predicted_qty == -1.0 and rows[1].diff == 3.5
    assert rows[3].diff is None and rows[3].wHist == 25.0
    assert [r.lag for r in rows] == [0.0, 1.0, 2.0, 3.0]


def test_unknown_pooled_model_is_an_error():
    with pytest.raises(ValueError):
        C.global_model_name("other", 20, "exp", None)


def test_seasonal_naive_tiles_the_last_season(spark):
    rows = [("a", D(2020, 1, 6) + dt.timedelta(days=7 * i), i) for i in range(110)]
    panel = spark.createDataFrame(rows, "series string, period date, qty bigint")
    rolling = Rolling("2020-01-06", "2021-01-04", "2021-01-04", horizon=60)
    got = {r.period: r.forecast_value for r in baseline.seasonal_naive(panel, rolling).collect()}
    assert len(got) == 60
    first = D(2021, 1, 4)
    for h in range(60):
        assert got[first + dt.timedelta(days=7 * h)] == float(h % 52)


def test_drift_continues_a_line(spark):
    rows = [("a", D(2020, 1, 6) + dt.timedelta(days=7 * i), 3 + 2 * i) for i in range(52)]
    panel = spark.createDataFrame(rows, "series string, period date, qty bigint")
    got = baseline.drift(panel, ONE).orderBy("period").collect()
    assert [r.forecast_value for r in got] == pytest.approx([3 + 2 * 52, 3 + 2 * 53])


def test_leaderboard_ranks_within_fold(spark):
    df = spark.createDataFrame(
        [("m1", "r", 0, 0.0, 5.0, 10), ("m2", "r", 0, 0.0, 1.0, 10), ("m1", "r", 1, 1.0, 1.0, 10)],
        "model_name string, run_id string, fold int, lag double, wAbsError double, wHist bigint")
    got = {(r.model_name, r.fold): r.model_rank for r in report.model_leaderboard(df).collect()}
    assert got == {("m2", 0): 1, ("m1", 0): 2, ("m1", 1): 1}
    by_lag = {(r.model_name, r.lag): r.wMAPE for r in report.wmape_by_lag(df).collect()}
    assert by_lag == {("m1", 0.0): 50.0, ("m2", 0.0): 10.0, ("m1", 1.0): 10.0}
