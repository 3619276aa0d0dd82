"""Baseline forecasters: what a model has to beat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.columns import period_days
from foldcast.operators.arima import fold_grid, remove_effects
from foldcast.operators.folds import Rolling, fan_out
from foldcast.operators.panel import fill_gaps


def _no_interval() -> list[Column]:
    return [F.lit(None).cast("double").alias(f"prediction_interval_{side}_bound")
            for side in ("lower", "upper")]


def seasonal_naive(panel: DataFrame, folds: Rolling | Column, season_days: int = 364,
                   series_col: str = "series", period_col: str = "period",
                   target_col: str = "qty") -> DataFrame:
    """Repeat the last season before each fold's test start over its test range.

    Every observed row of that season is moved ahead by whole seasons, so no
    self-join is needed. A period whose look-back has no row gets no forecast row
    here and counts as 0 once it meets the scaffold.
    """
    period = F.col(period_col)
    season = F.make_dt_interval(F.lit(season_days))
    last_season = fan_out(
        panel.select(series_col, period_col, target_col), folds,
        lambda f: (period >= F.date_sub(f["test_start_date"], season_days))
        & (period < f["test_start_date"])
        & (F.date_add(period, season_days) < f["test_end_date"]))
    ahead = F.sequence(F.date_add(period, season_days),
                       F.date_sub(F.col("f.test_end_date"), 1), season)
    return last_season.select(
        F.col("f.fold").alias("fold"), series_col, F.explode(ahead).alias(period_col),
        F.lit("forecast").alias("time_series_type"),
        F.col(target_col).cast("double").alias("forecast_value"), *_no_interval())


def drift(panel: DataFrame, rolling: Rolling, series_col: str = "series",
          period_col: str = "period", target_col: str = "qty",
          granularity: str = "WEEKLY") -> DataFrame:
    """A straight line through each series' zero-filled history.

    Training windows only ever grow, so a running sum read at the last training period
    gives a fold its line: history is never repeated per fold.
    """
    days = period_days(granularity)
    grid = fill_gaps(panel.select(series_col, period_col, target_col), series_col, period_col,
                     target_col, granularity, end=F.date_sub(rolling.last_day(), 1))
    w = Window.partitionBy(series_col).orderBy(period_col)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t, y = F.col("t"), F.col(target_col)
    running = grid.withColumn("t", F.row_number().over(w).cast("bigint")).withColumns({
        "st": F.sum(t).over(upto), "stt": F.sum(t * t).over(upto),
        "sy": F.sum(y).over(upto), "sty": F.sum(t * y).over(upto)})
    # Sums of whole numbers are exact, so the line does not depend on their order.
    cov = t * F.col("sty") - F.col("st") * F.col("sy")
    var = t * F.col("stt") - F.col("st") * F.col("st")
    period = F.col(period_col)
    last = fan_out(running.withColumn("slope", F.coalesce(
        F.try_divide(cov.cast("double"), var.cast("double")), F.lit(0.0))), rolling,
        lambda f: (period < f["test_start_date"])
        & (F.date_add(period, days) >= f["test_start_date"]))
    steps = F.sequence(F.date_add(period, days), F.date_sub(F.col("f.test_end_date"), 1),
                       F.make_dt_interval(F.lit(days)))
    ahead = last.select(
        F.col("f.fold").alias("fold"), series_col, "t", "st", "sy", "slope",
        F.posexplode(steps).alias("h", period_col))
    # At the last training period t is also the number of training periods.
    value = F.col("sy") / t + F.col("slope") * (t + F.col("h") + 1 - F.col("st") / t)
    return ahead.select("fold", series_col, period_col,
                        F.lit("forecast").alias("time_series_type"),
                        value.alias("forecast_value"), *_no_interval())


def trend_season(panel: DataFrame, rolling: Rolling, series_col: str = "series",
                 period_col: str = "period", target_col: str = "qty",
                 granularity: str = "WEEKLY") -> DataFrame:
    """A straight line through the seasonally adjusted history, plus the season."""
    rows = remove_effects(
        fold_grid(panel, rolling, series_col=series_col, period_col=period_col,
                  target_col=target_col, granularity=granularity), series_col, period_col)
    whole = Window.partitionBy(series_col, "fold")
    known = F.when(F.col("z").isNotNull(), F.col("t").cast("double"))
    rows = rows.withColumns({
        "__my": F.avg("z").over(whole), "__mt": F.avg(known).over(whole),
        "__cov": F.covar_pop(F.col("z"), known).over(whole),
        "__var": F.var_pop(known).over(whole)})
    slope = F.coalesce(F.try_divide(F.col("__cov"), F.col("__var")), F.lit(0.0))
    value = F.col("__my") + slope * (F.col("t") - F.col("__mt")) + F.col("seasonal")
    return rows.filter(F.col("time_series_type") == "forecast").select(
        "fold", series_col, period_col, "time_series_type",
        value.alias("forecast_value"), *_no_interval())
