"""Joining forecasts to actuals, and error metrics.

A forecast has the columns ``fold``, series, period, ``time_series_type`` ('history'
or 'forecast'), ``forecast_value`` and the two ``prediction_interval_*_bound``s, with
one row per (fold, series, period), so every join below is on a unique key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.functions import metrics
from foldcast.functions.columns import (clamp, fold_run_name, lag_index, run_id, to_bigint,
                                        weighted_abs_error)
from foldcast.operators.folds import Rolling, fan_out
from foldcast.operators.scaffold import scaffold_actuals

FORECAST_COLUMNS = ["time_series_type", "forecast_value", "prediction_interval_lower_bound",
                    "prediction_interval_upper_bound"]


def dashboard_rows(panel: DataFrame, forecasts: DataFrame, folds: Rolling | Column,
                   model_name: str, run_name: str, series_col: str = "series",
                   period_col: str = "period", target_col: str = "qty",
                   granularity: str = "WEEKLY", align: bool = True,
                   end_inclusive: bool = True, timestamp: bool = False) -> DataFrame:
    """One row per (fold, series, test date): actual, clamped forecast and interval,
    error terms and run metadata. Dates without a forecast count as forecast 0.

    ``predicted_p10``/``predicted_p90`` hold whatever interval the forecast carries.
    """
    hist = scaffold_actuals(panel, folds, series_col, period_col, target_col,
                            granularity, align, end_inclusive)
    hist = hist.withColumn("model_name", F.lit(model_name))
    return _error_rows(hist, forecasts, ["fold", series_col, period_col], run_name, series_col,
                       period_col, target_col, granularity, timestamp)


def compare_models(panel: DataFrame, forecasts: Mapping[str, DataFrame],
                   folds: Rolling | Column, run_name: str, series_col: str = "series",
                   period_col: str = "period", target_col: str = "qty",
                   granularity: str = "WEEKLY", align: bool = True,
                   end_inclusive: bool = True) -> DataFrame:
    """Dashboard rows of several models: the scaffold is built once and meets all
    forecasts in one join."""
    hist = scaffold_actuals(panel, folds, series_col, period_col, target_col,
                            granularity, align, end_inclusive)
    names = F.array(*[F.lit(name) for name in forecasts])
    hist = hist.withColumn("model_name", F.explode(names))
    pooled = None
    for name, rows in forecasts.items():
        rows = rows.select("fold", series_col, period_col, *FORECAST_COLUMNS).withColumn(
            "model_name", F.lit(name))
        pooled = rows if pooled is None else pooled.unionByName(rows)
    return _error_rows(hist, pooled, ["model_name", "fold", series_col, period_col], run_name,
                       series_col, period_col, target_col, granularity, False)


def _error_rows(hist: DataFrame, forecasts: DataFrame, keys: list[str], run_name: str,
                series_col: str, period_col: str, target_col: str, granularity: str,
                timestamp: bool) -> DataFrame:
    ahead = forecasts.filter(F.col("time_series_type") == "forecast").select(
        *keys, *FORECAST_COLUMNS[1:])
    joined = hist.join(ahead, keys, "left")
    actual, forecast = F.col("actualQty"), F.col("forecastQty")
    out = (
        joined.withColumn("actualQty", F.col(target_col))
        .withColumn("forecastQty", clamp("forecast_value"))
        .withColumn("predicted_p10", clamp("prediction_interval_lower_bound"))
        .withColumn("predicted_p90", clamp("prediction_interval_upper_bound"))
        .select(
            period_col, series_col, "actualQty", "forecastQty", "predicted_p10",
            "predicted_p90", "model_name",
            run_id(fold_run_name(run_name, "fold")).alias("run_id"), "fold",
            lag_index(period_col, F.col("test_start_date"), granularity).alias("lag"),
            (actual - forecast).alias("diff"),
            weighted_abs_error(actual, forecast).alias("wAbsError"),
            (actual * actual).alias("wHist")))
    return out.withColumn("eval_timestamp", F.current_timestamp()) if timestamp else out


def eval_rows(panel: DataFrame, forecasts: DataFrame, folds: Rolling | Column,
              series_col: str = "series", period_col: str = "period",
              target_col: str = "qty", granularity: str = "WEEKLY",
              test_only: bool = False) -> DataFrame:
    """Every actual of every fold, left-joined to its forecast row, with errors.

    ``test_only`` keeps each fold's test range: all that ``global_wmape`` looks at, and a
    small part of the rows.
    """
    period = F.col(period_col)

    def tested(f: Column) -> Column:
        return (period >= f["test_start_date"]) & (period < f["test_end_date"])

    actual = panel.groupBy(series_col, F.col(period_col).cast("date").alias(period_col)).agg(
        F.sum(target_col).alias("actual_value"))
    actual = fan_out(actual, folds, tested if test_only else None).select(
        F.col("f.fold").alias("fold"), F.col(series_col).alias(f"a_{series_col}"),
        F.col(period_col), "actual_value",
        F.col("f.test_start_date").alias("test_start_date"),
        F.col("f.test_end_date").alias("test_end_date"))
    right = forecasts.select(
        F.col("fold").alias("f_fold"), F.col(series_col),
        F.col(period_col).alias(f"f_{period_col}"), *FORECAST_COLUMNS)
    joined = actual.join(
        right, (F.col("fold") == F.col("f_fold"))
        & (F.col(period_col) == F.col(f"f_{period_col}"))
        & (F.col(f"a_{series_col}") == F.col(series_col)), "left").drop("f_fold")
    value, filled = F.col("actual_value"), F.col("forecast_value_filled")
    return (
        joined.withColumn("forecast_value_filled", clamp("forecast_value"))
        .withColumn("diff", value - filled)
        .withColumn("wAbsError", weighted_abs_error(value, filled))
        .withColumn("wHist", value * value)
        .withColumn("wMAPE", F.try_divide(F.col("wAbsError") * F.lit(100.0),
                                          F.col("wHist").cast("double")))
        .withColumn("lag", lag_index(period_col, F.col("test_start_date"), granularity)))


def global_wmape(rows: DataFrame, period_col: str = "period",
                 with_cold_starts: bool = False) -> DataFrame:
    """wMAPE of each fold's test range over ``eval_rows``.

    Rows without any forecast (cold starts) are left out unless asked for.
    """
    inside = rows.filter((F.col(period_col) >= F.col("test_start_date"))
                         & (F.col(period_col) < F.col("test_end_date")))
    kind = F.col("time_series_type")
    keep = kind == "forecast"
    if with_cold_starts:
        keep = keep | kind.isNull()
    return inside.filter(keep).groupBy("fold").agg(metrics.wmape().alias("wMAPE"))


def full_eval_rows(panel: DataFrame, forecasts: DataFrame, folds: Rolling | Column,
                   series_col: str = "series", period_col: str = "period",
                   target_col: str = "qty", granularity: str = "WEEKLY") -> DataFrame:
    """Every actual and every forecast row of every fold: a full join, planned as a union and
    one aggregation by (fold, series, period), so with one shuffle and equal NULL keys.

    ``side`` tells whether a row had both, an 'actual' alone or a 'forecast' alone. A missing
    forecast counts as 0, and so does a missing actual: nothing was sold. A forecast alone
    thus weighs nothing in wMAPE but counts in the other metrics. Forecasts of folds that
    ``folds`` does not have are left out; actuals of one key are summed, and of repeated
    forecast rows the greatest by kind and value stays.
    """
    keys = ["fold", series_col, period_col]
    period = F.col(period_col).cast("date").alias(period_col)
    actual = panel.groupBy(series_col, period).agg(F.sum(target_col).alias("actual_value"))
    actual = fan_out(actual, folds).select(
        F.col("f.fold").alias("fold"), series_col, period_col, "actual_value",
        F.lit(None).alias("__forecast"), "f")
    array = folds.array() if isinstance(folds, Rolling) else folds
    own = F.get(F.filter(array, lambda f: f["fold"] == F.col("fold")), F.lit(0))
    ahead = forecasts.select(
        "fold", series_col, period, F.lit(None).alias("actual_value"),
        F.struct(*FORECAST_COLUMNS).alias("__forecast"), own.alias("f")).filter("f IS NOT NULL")
    joined = actual.unionByName(ahead).groupBy(*keys).agg(
        F.sum("actual_value").alias("actual_value"), F.count("actual_value").alias("__a"),
        F.max("__forecast").alias("__forecast"), F.max("f").alias("f"))
    value = F.coalesce("actual_value", F.lit(0))
    filled = F.col("forecast_value_filled")
    has_forecast = F.col("__forecast").isNotNull()
    return (
        joined.withColumn("forecast_value_filled", clamp("__forecast.forecast_value"))
        .select(
            *keys, F.when(has_forecast & (F.col("__a") > 0), "both").when(
                has_forecast, "forecast").otherwise("actual").alias("side"),
            "actual_value", *[F.col(f"__forecast.{c}").alias(c) for c in FORECAST_COLUMNS],
            "forecast_value_filled", F.col("f.test_start_date").alias("test_start_date"),
            F.col("f.test_end_date").alias("test_end_date"),
            (value - filled).alias("diff"),
            weighted_abs_error(value, filled).alias("wAbsError"),
            (value * value).alias("wHist"),
            lag_index(period_col, F.col("f.test_start_date"), granularity).alias("lag")))


def full_metrics(rows: DataFrame, period_col: str = "period") -> DataFrame:
    """All metrics of each fold's test range over ``full_eval_rows``, and how many rows had
    both sides or one."""
    tested = rows.filter((F.col(period_col) >= F.col("test_start_date"))
                         & (F.col(period_col) < F.col("test_end_date")))
    tested = tested.withColumn("actual_value", F.coalesce("actual_value", F.lit(0)))
    return tested.groupBy("fold").agg(*metrics.metric_suite(), *[
        F.count(F.when(F.col("side") == side, 1)).alias(f"n_{side}")
        for side in ("both", "actual", "forecast")])


def dashboard_wmape(rows: DataFrame, keys: Sequence[str] = ("fold",)) -> DataFrame:
    """wMAPE over every scaffold row, cold starts included."""
    return rows.groupBy(*keys).agg(metrics.wmape().alias("wMAPE"))


# --- pooled-model path ---------------------------------------------------------------


def to_evaluated_items(items: DataFrame, value_col: str, target_col: str = "qty") -> DataFrame:
    """Pack the prediction the way pooled models export it: a struct with ``value``."""
    return items.withColumn(
        f"predicted_{target_col}", F.struct(F.col(value_col).alias("value"))).drop(value_col)


def on_time(items: DataFrame, period_col: str = "period") -> DataFrame:
    """Keep the predictions that were made on the period itself."""
    return items.filter(F.col(period_col) == F.col(f"predicted_on_{period_col}"))


def evaluated_dashboard_rows(items: DataFrame, model_name: Column, run_name: str,
                             test_start: Column, series_col: str = "series",
                             period_col: str = "period", target_col: str = "qty",
                             carry: Sequence[str] = (), granularity: str = "WEEK",
                             timestamp: bool = False) -> DataFrame:
    """Dashboard rows of exported items. Predictions are not clamped here, and a
    missing prediction leaves its errors NULL."""
    actual, predicted = F.col(f"actual_{target_col}"), F.col(f"predicted_{target_col}")
    out = (
        on_time(items, period_col)
        .select(
            F.col(period_col).cast("date").alias(period_col),
            F.col(f"predicted_on_{period_col}").cast("date").alias(
                f"predicted_on_{period_col}"),
            F.col(target_col).cast("double").alias(f"actual_{target_col}"),
            F.col(series_col),
            F.col(f"predicted_{target_col}.value").alias(f"predicted_{target_col}"),
            *carry, model_name.alias("model_name"),
            run_id(fold_run_name(run_name, "fold")).alias("run_id"), "fold",
            lag_index(F.col(period_col).cast("date"), test_start, granularity).alias("lag"))
        .withColumn("diff", actual - predicted)
        .withColumn("wAbsError", weighted_abs_error(actual, predicted))
        .withColumn("wHist", actual * actual))
    return out.withColumn("eval_timestamp", F.current_timestamp()) if timestamp else out


def evaluated_errors(items: DataFrame, series_col: str = "series",
                     period_col: str = "period", target_col: str = "qty",
                     clamp_errors: bool = False) -> DataFrame:
    """Per-item errors of exported items. Targets become whole numbers first. Errors
    use the raw prediction unless ``clamp_errors``."""
    predicted = F.col(f"predicted_{target_col}.value")
    actual, used = F.col("actual_value"), F.col("__used")
    return (
        on_time(items, period_col)
        .select("fold", series_col, F.col(period_col).cast("date").alias(period_col),
                F.lit("forecast").alias("time_series_type"),
                clamp(predicted).alias("forecast_value"),
                to_bigint(target_col).alias("actual_value"),
                (clamp(predicted) if clamp_errors else predicted).alias("__used"))
        .withColumn("diff", actual - used)
        .withColumn("wAbsError", weighted_abs_error(actual, used))
        .withColumn("wHist", actual * actual)
        .drop("__used"))


def metric_suite(errors: DataFrame, keys: Sequence[str] = ("fold", "time_series_type")
                 ) -> DataFrame:
    return errors.groupBy(*keys).agg(*metrics.metric_suite())
