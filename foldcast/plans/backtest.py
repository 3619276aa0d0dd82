"""Rolling backtests: all folds and all series of a model in one plan.

Where a step has to be stored (the forecast feeds both the dashboard and the
evaluation), it is written once to the shared scratch folder and read back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.functions.columns import fold_run_name, global_model_name
from foldcast.operators import arima, auto_arima, baseline, holiday, pooled, score, xreg
from foldcast.operators.folds import Rolling, fan_out, fold_table
from foldcast.sources import tables
from foldcast.sources.scratch import cut_lineage

# Coverage of the dashboard's and the evaluation's intervals.
DASHBOARD_CONFIDENCE, EVALUATION_CONFIDENCE = 0.9, 0.95
# Periods of a year.
SEASONS = {"WEEKLY": 52, "DAILY": 365}


@dataclass(frozen=True)
class Backtest:
    """The results of a backtest, all over every fold."""

    forecasts: DataFrame
    dashboard: DataFrame
    evaluation: DataFrame
    metrics: DataFrame
    log: DataFrame
    run_name: str
    model_name: str


def seasonal_naive_rows(panel: DataFrame, rolling: Rolling, run_name: str,
                        **options) -> DataFrame:
    """Dashboard rows of the seasonal-naive baseline."""
    forecasts = baseline.seasonal_naive(panel, rolling)
    return score.dashboard_rows(panel, forecasts, rolling, "seasonal_naive", run_name, **options)


def seasonal_naive_wmape(panel: DataFrame, rolling: Rolling) -> DataFrame:
    """wMAPE per fold of the seasonal-naive baseline over the full scaffold."""
    return score.dashboard_wmape(seasonal_naive_rows(panel, rolling, "baseline")).orderBy("fold")


def arima_forecasts(panel: DataFrame, rolling: Rolling, covariates: Sequence[str] = (),
                    calendar: DataFrame | None = None, attributes: Sequence[str] = (),
                    holiday_regions: Sequence[str] = (), max_order: int = 5,
                    fill: str = "zero", origin: str = "test_start",
                    granularity: str = "WEEKLY", season: int | None = None,
                    series_covariates: Sequence[str] = (), adjusted: bool = False
                    ) -> DataFrame:
    """Forecast rows of an ARIMA model per (fold, series), on regressors when there are
    any, with fitted history and components. ``max_order`` 1 takes the closed-form models.
    A season is a year of periods unless it is given. ``adjusted`` fits on history without
    its spikes, dips and step changes, and explains them."""
    season = season or SEASONS[granularity]
    holidays = None
    if holiday_regions:
        holidays = holiday.holiday_calendar(
            panel.sparkSession.range(1), rolling.train_start, rolling.last_day(),
            list(holiday_regions), granularity)
    grid = arima.fold_grid(panel, rolling, calendar, covariates, holidays, fill=fill,
                           granularity=granularity, attributes=attributes, origin=origin,
                           season=season, series_covariates=series_covariates)
    if covariates or attributes or series_covariates:
        grid = xreg.remove_many(grid, [*covariates, *attributes, *series_covariates])
    if max_order <= 1:
        return arima.explain(arima.fit(grid, season=season, adjusted=adjusted))
    return auto_arima.explain(grid, rolling.periods(granularity), max_order, max(8, max_order),
                              granularity=granularity, season=season, adjusted=adjusted)


def arima_backtest(panel: DataFrame, rolling: Rolling, run_name: str,
                   model_name: str = "arima", lower: float | None = None,
                   upper: float | None = None, granularity: str = "WEEKLY",
                   **options) -> Backtest:
    """Split, train, forecast, join to actuals and score, for every fold at once."""
    forecasts = cut_lineage(arima_forecasts(
        panel, rolling, granularity=granularity, **options), "forecasts")
    board = score.dashboard_rows(
        panel, arima.with_interval(forecasts, DASHBOARD_CONFIDENCE, lower, upper), rolling,
        model_name, run_name, granularity=granularity)
    rows = score.eval_rows(
        panel, arima.with_interval(forecasts, EVALUATION_CONFIDENCE, lower, upper), rolling,
        granularity=granularity)
    scores = score.global_wmape(rows).withColumnRenamed("wMAPE", "Global_wMAPE")
    params = {"model_type": model_name, "horizon": rolling.horizon,
              "data_frequency": granularity, **options}
    return Backtest(forecasts, board, rows, scores, _log(scores, run_name, params), run_name,
                    model_name)


def pooled_backtest(panel: DataFrame, rolling: Rolling, run_name: str, kind: str,
                    context: int = 20, experiment: str = "demand",
                    carry: Sequence[str] = (), granularity: str = "WEEK",
                    **options) -> Backtest:
    """The same for a pooled model, through its exported evaluated items."""
    forecasts = cut_lineage(pooled.fit_and_forecast(
        panel, rolling, kind, context, granularity=granularity, **options), "forecasts")
    items = cut_lineage(evaluated_items(panel, forecasts, rolling, carry), "items")
    name = global_model_name(kind, context, experiment, fold_run_name(run_name, "fold"))
    board = score.evaluated_dashboard_rows(
        items, name, run_name, F.col("test_start_date"), carry=carry, granularity=granularity)
    errors = score.evaluated_errors(items)
    scores = score.metric_suite(errors).drop("time_series_type")
    params = {"model_type": kind, "horizon": rolling.horizon, "data_frequency": granularity,
              "context_window": context,
              **{k: v for k, v in options.items() if not isinstance(v, DataFrame)}}
    return Backtest(forecasts, board, errors, scores, _log(scores, run_name, params), run_name,
                    kind)


def evaluated_items(panel: DataFrame, forecasts: DataFrame, rolling: Rolling,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Test rows of every fold with the prediction packed as a struct."""
    period = F.col("period")
    tested = fan_out(panel.select("series", "period", "qty", *carry), rolling, lambda f: (
        period >= f["test_start_date"]) & (period < f["test_end_date"]))
    tested = tested.withColumns({"fold": F.col("f.fold"), "predicted_on_period": period,
                                 "test_start_date": F.col("f.test_start_date")}).drop("f")
    ahead = forecasts.filter(F.col("time_series_type") == "forecast").select(
        "fold", "series", "period", "forecast_value")
    joined = tested.join(ahead, ["fold", "series", "period"], "left")
    return score.to_evaluated_items(joined, "forecast_value")


def _log(scores: DataFrame, run_name: str, params: Mapping[str, object]) -> DataFrame:
    named = scores.withColumn("run_name", fold_run_name(run_name, "fold"))
    metrics = [c for c in scores.columns if c != "fold"]
    return tables.run_log(named, "run_name", dict(params), metrics)


def publish(result: Backtest, root: str) -> None:
    """Append the dashboard rows and the run log under ``root``; replace this run's
    evaluation rows of this model. Those of other runs and models stay."""
    tables.append_table(result.dashboard, f"{root}/dashboard")
    result.log.write.mode("append").parquet(f"{root}/runs")
    named = result.evaluation.withColumns({
        "run_id": F.lit(result.run_name), "model_name": F.lit(result.model_name)})
    tables.replace_partitions(named, f"{root}/evaluation", ["run_id", "model_name", "fold"])


def folds_of(panel: DataFrame, rolling: Rolling) -> DataFrame:
    return fold_table(panel.sparkSession.range(1), rolling)
