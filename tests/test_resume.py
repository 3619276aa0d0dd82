"""Stopped and resumed runs, and the full join of actuals and forecasts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foldcast.operators import baseline, score
from foldcast.operators.folds import Rolling, fold_table
from foldcast.plans import resume as R

START = dt.date(2018, 1, 1)
ROLLING = Rolling("2018-01-01", "2019-06-03", "2019-11-04", horizon=4)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(s, START + dt.timedelta(days=7 * i), i % 9 + 1) for s in "ab" for i in range(110) if s == "a" or i % 4]
    return spark.createDataFrame(rows, "series string, period date, qty bigint")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def expected(panel):
    return score.dashboard_rows(panel, baseline.seasonal_naive(panel, ROLLING), ROLLING, "m", "r")


def test_kept_folds_have_their_numbers(spark):
    some = Rolling("2018-01-01", "2019-06-03", "2019-11-04", horizon=4, only=(1, 3))
    every = {r.fold: r for r in fold_table(spark.range(1), ROLLING).collect()}
    assert [r for r in fold_table(spark.range(1), some).collect()] == [every[1], every[3]]


def test_a_resumed_run_equals_one_run(spark, panel, tmp_path):
    fitted = []

    def forecast(rows, rolling):
        fitted.extend(rolling.only)
        return baseline.seasonal_naive(rows, rolling)

    def run(**options):
        return R.resume(panel, ROLLING, "r", "m", forecast, str(tmp_path), **options)

    first = run(most=2)
    assert rows_of(first) == rows_of(expected(panel).filter("fold < 2"))

    def dies(rows, rolling):
        if 4 in rolling.only:
            raise RuntimeError("lost")
        return forecast(rows, rolling)

    with pytest.raises(RuntimeError):
        R.resume(panel, ROLLING, "r", "m", dies, str(tmp_path), at_once=1)
    assert R.pending_folds(spark, ROLLING, str(tmp_path), "r", "m") == [4, 5]
    assert rows_of(run()) == rows_of(expected(panel))
    assert rows_of(run()) == rows_of(expected(panel))
    assert fitted == list(range(6))


def test_rows_without_a_manifest_entry_are_written_again(spark, panel, tmp_path):
    """Stopped between the rows and the manifest: not told, then replaced, never doubled."""
    root, part = str(tmp_path), Rolling("2018-01-01", "2019-06-03", "2019-11-04", horizon=4, only=(0, 1))
    rows = score.dashboard_rows(panel, baseline.seasonal_naive(panel, part), part, "m", "r")
    R.tables.replace_partitions(rows.withColumn("run_name", F.lit("r")), f"{root}/dashboard", R.KEYS)
    schema = rows.withColumn("run_name", F.lit("r")).schema
    assert R.finished(spark, root, "r", "m", schema).count() == 0
    done = R.resume(panel, ROLLING, "r", "m", baseline.seasonal_naive, root)
    assert rows_of(done) == rows_of(expected(panel))
    other = R.resume(panel, ROLLING, "r", "n", baseline.seasonal_naive, root, most=1)
    assert {r.fold for r in other.collect()} == {0} and rows_of(R.finished(spark, root, "r", "m", schema)) == rows_of(expected(panel))
    counts = {r.fold: r.n_rows for r in R.manifest(spark, root).filter("model_name = 'm'").collect()}
    assert counts == {r.fold: r.n for r in expected(panel).groupBy("fold").agg(F.count("*").alias("n")).collect()}


def test_both_sides_meet_once(spark):
    panel = spark.createDataFrame([("a", dt.date(2019, 6, 3), 5), ("a", dt.date(2019, 6, 3), 2), (None, dt.date(2019, 6, 10), 4)], "series string, period date, qty bigint")
    kind = "fold int, series string, period date, time_series_type string, forecast_value double, prediction_interval_lower_bound double, prediction_interval_upper_bound double"
    ahead = spark.createDataFrame([
        (0, "a", dt.date(2019, 6, 3), "forecast", 6.0, None, None), (0, "a", dt.date(2019, 6, 17), "forecast", -2.0, None, None),
        (0, "b", dt.date(2019, 6, 10), "forecast", 3.0, None, None), (0, None, dt.date(2019, 6, 10), "forecast", 1.0, None, None),
        (9, "a", dt.date(2019, 6, 3), "forecast", 6.0, None, None)], kind)
    one = Rolling("2018-01-01", "2019-06-03", "2019-06-03", horizon=4)
    rows = score.full_eval_rows(panel, ahead, one)
    got = {(r.series, r.period.day): (r.side, r.actual_value, r["diff"], r.wAbsError) for r in rows.collect()}
    assert got == {("a", 3): ("both", 7, 1.0, 7.0), ("a", 17): ("forecast", None, 0.0, 0.0), ("b", 10): ("forecast", None, -3.0, 0.0), (None, 10): ("both", 4, 3.0, 12.0)}
    r = score.full_metrics(rows).first()
    assert (r.n_both, r.n_actual, r.n_forecast) == (2, 0, 2)
    assert r.MAE == pytest.approx(7 / 4) and r.wMAPE == pytest.approx(100 * 19 / 65)
    assert score.full_eval_rows(panel.where("false"), ahead.where("false"), one).count() == 0
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
