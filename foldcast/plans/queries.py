"""The registered queries: name -> (Spark plan, SQL twin or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.functions import columns as C
from foldcast.operators import (adjust, arima, auto_arima, baseline, decompose, dense, folds,
                                gaps, holiday, lowess, pooled, profile, report, scaffold, score, xreg)
from foldcast.operators import panel as P
from foldcast.plans import backtest
from foldcast.plans import oracles as O
from foldcast.plans import resume as R
from foldcast.sources import bindings as B
from foldcast.sources import scratch, tables
from foldcast.sources.scratch import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL twin when there is one."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round for comparison with another engine. Its sums differ in their last bits; these go
    first, four digits further, so that exact halves fall alike."""
    return df.withColumns({c: F.round(F.round(F.col(c), digits + 4), digits) for c in columns})


FEATURES = ["qty", "percentage_rain", *B.ATTRIBUTES, "series"]
RUN = "run-2001"
ROLL = O.folds(B.ROLLING)
ERRORS = "forecastQty, predicted_p10, predicted_p90, diff, wAbsError"


# --- panel ---------------------------------------------------------------------------

@query(O.with_(O.TRIPS) + "SELECT event_ts, unit_id, origin_name, dest_name, series FROM trips")
def series_id(spark, sf_dir):
    trips = B.trips(spark, sf_dir).select("event_ts", "unit_id", "origin_name", "dest_name")
    return P.with_series_id(trips, ["origin_name", "dest_name"])


@query(O.with_(O.PANEL) + "SELECT * FROM panel")
def weekly_panel(spark, sf_dir):
    return B.weekly_panel(spark, sf_dir)


@query(O.with_(O.DAILY) + "SELECT * FROM panel")
def daily_panel(spark, sf_dir):
    return B.daily_panel(spark, sf_dir)


@query(O.with_(O.PARTS) + "SELECT * FROM panel")
def part_panel(spark, sf_dir):
    return B.part_panel(spark, sf_dir)


@query(O.with_(O.WEATHER) + "SELECT * FROM weather")
def weather_calendar(spark, sf_dir):
    return B.weather(spark, sf_dir)


@query(O.with_(O.WEATHER) + """
SELECT period, CAST('0x' || substr(md5('42:' || strftime(period, '%Y-%m-%d')), 1, 8) AS BIGINT)
  / 4294967296.0::DOUBLE AS percentage_rain FROM weather""")
def weather_simulated(spark, sf_dir):
    spine = P.period_spine(B.event_bounds(spark, sf_dir), F.col("first_period"),
                           F.col("last_period"))
    return P.simulate_covariate(spine, "percentage_rain", seed=42)


@query(O.with_(O.PANEL, O.WEATHER) + """
SELECT p.*, w.percentage_rain FROM panel p LEFT JOIN weather w ON p.period = w.period""")
def enrich_weather(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    return P.enrich(panel, B.weather(spark, sf_dir, panel))


@query(O.with_(O.PANEL) + "SELECT * FROM panel ORDER BY period, series LIMIT 5")
def preview_panel(spark, sf_dir):
    return tables.preview(B.weekly_panel(spark, sf_dir), ["period", "series"])


@query(O.with_(O.DENSE) + "SELECT series, period, qty FROM panel")
def filled_panel(spark, sf_dir):
    return P.fill_gaps(B.core_panel(spark, sf_dir), end=B.LAST_PERIOD)


# --- profile -------------------------------------------------------------------------

@query(O.with_(O.PANEL) + "SELECT count(DISTINCT series) AS n_series FROM panel")
def n_series(spark, sf_dir):
    return profile.count_series(B.weekly_panel(spark, sf_dir))


@query(O.with_(O.PANEL) + "SELECT min(period) AS start_date, max(period) AS end_date FROM panel")
def date_range(spark, sf_dir):
    return profile.date_range(B.weekly_panel(spark, sf_dir))


@query(O.with_(O.PANEL) + """
SELECT series, CAST(date_diff('day', min(period), max(period)) AS INTEGER) AS history_days
FROM panel GROUP BY series""")
def history_days(spark, sf_dir):
    return profile.history_days(B.weekly_panel(spark, sf_dir))


@query(O.with_(O.ORDERS_PANEL) + """,
durations AS (
  SELECT series, date_diff('day', min(period), max(period)) AS d FROM panel GROUP BY series),
labelled AS (
  SELECT series,
    CASE WHEN d > 3 * 365 THEN 'More than 3 years'
         WHEN d >= 2 * 365 AND d <= 3 * 365 THEN 'Between 2 and 3 years'
         WHEN d >= 365 AND d < 2 * 365 THEN 'Between 1 and 2 years'
         WHEN d >= 182 AND d < 365 THEN 'Between 6 months and 1 year'
         ELSE 'Less than 6 months' END AS history_category,
    CAST(CASE WHEN d > 3 * 365 THEN 1 WHEN d >= 2 * 365 THEN 2 WHEN d >= 365 THEN 3
         WHEN d >= 182 THEN 4 ELSE 5 END AS INTEGER) AS bucket_rank
  FROM durations)
SELECT history_category, bucket_rank, count(series) AS number_of_time_series,
       CAST(round(CAST((count(series) * 100.0 / (SELECT count(*) FROM labelled)) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS percentage
FROM labelled GROUP BY 1, 2 ORDER BY 2""")
def history_buckets(spark, sf_dir):
    return rounded(profile.history_buckets(B.orders_panel(spark, sf_dir)), "percentage")


@query(O.with_(O.PANEL, O.WEATHER) + """,
enriched AS (SELECT p.*, w.percentage_rain FROM panel p
             LEFT JOIN weather w ON p.period = w.period)
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS value_count FROM enriched WHERE {c} IS NULL"
    for c in [*B.ATTRIBUTES, "percentage_rain"]))
def missing_values(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    enriched = P.enrich(panel, B.weather(spark, sf_dir, panel))
    return profile.missing_values(enriched, [*B.ATTRIBUTES, "percentage_rain"])


@query(O.with_(O.PANEL) + """
SELECT period, CAST(sum(qty) AS BIGINT) AS qty FROM panel GROUP BY period""")
def total_demand(spark, sf_dir):
    return profile.total_demand(B.weekly_panel(spark, sf_dir))


@query(O.with_(O.PANEL, O.WEATHER) + """,
enriched AS (SELECT p.*, w.percentage_rain FROM panel p
             LEFT JOIN weather w ON p.period = w.period)
""" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS input, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  CAST(round(CAST((avg({c})) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS mean, CAST(median({c}) AS DOUBLE) AS median,
  CAST(round(CAST((stddev_samp({c})) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS stddev, CAST(NULL AS BIGINT) AS category_count,
  count(*) - count({c}) AS null_count FROM enriched""" for c in FEATURES[:-1]) + """
UNION ALL SELECT 'series', NULL, NULL, NULL, NULL, NULL, count(DISTINCT series),
  count(*) - count(series) FROM enriched""")
def feature_info(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    enriched = P.enrich(panel, B.weather(spark, sf_dir, panel))
    return rounded(profile.feature_info(enriched, FEATURES), "mean", "stddev")


# --- folds ---------------------------------------------------------------------------

@query(O.with_(O.BOUNDS) + """
SELECT first_period AS train_start_date, test_start_date, test_start_date + 70 AS test_end_date,
       test_start_date - 70 AS val_start_date,
       CAST(floor(date_diff('day', first_period, test_start_date - 70) / 7.0) AS INTEGER)
         AS train_length,
       CAST(10 AS INTEGER) AS test_length, CAST(10 AS INTEGER) AS val_length,
       CAST(row_number() OVER (ORDER BY test_start_date) - 1 AS INTEGER) AS fold
FROM (SELECT first_period, CAST(unnest(generate_series(DATE '2000-01-03', last_period,
             INTERVAL 70 DAY)) AS DATE) AS test_start_date FROM bounds)""")
def fold_table(spark, sf_dir):
    rolling = folds.Rolling(F.col("first_period"), "2000-01-03", F.col("last_period"), 10, 10)
    return folds.fold_table(B.event_bounds(spark, sf_dir), rolling)


@query(ORACLES["fold_table"])
def folds_json_roundtrip(spark, sf_dir):
    path = scratch.scratch_path(spark, "folds")
    folds.write_folds(fold_table(spark, sf_dir), path)
    return folds.read_folds(spark, path)


@query(O.with_(O.PANEL, O.labelled(B.ROLLING)) + "SELECT * FROM labelled")
def split_train_test(spark, sf_dir):
    return folds.split_train_test(B.core_panel(spark, sf_dir), B.ROLLING)


@query(O.with_(O.PANEL, O.labelled(B.ROLLING)) + """
SELECT fold, split, count(*) AS n_rows FROM labelled GROUP BY fold, split""")
def split_counts(spark, sf_dir):
    return folds.count_splits(B.core_panel(spark, sf_dir), B.ROLLING)


@query(ORACLES["split_counts"])
def split_counts_labelled(spark, sf_dir):
    return folds.split_counts(split_train_test(spark, sf_dir))


@query(O.with_(O.PANEL, O.labelled(B.ROLLING)) + """
SELECT * FROM labelled WHERE split IN ('TRAIN', 'VALIDATE')""")
def training_rows(spark, sf_dir):
    return folds.training_rows(split_train_test(spark, sf_dir))


@query(O.with_(O.PANEL, ROLL, O.scaffold()) + "SELECT * FROM scaffold")
def date_scaffold(spark, sf_dir):
    return scaffold.date_scaffold(B.core_panel(spark, sf_dir), B.ROLLING)


@query(O.with_(O.PANEL, ROLL, O.scaffold()) + "SELECT * FROM hist")
def scaffold_actuals(spark, sf_dir):
    return scaffold.scaffold_actuals(B.prepared_panel(spark, sf_dir), B.ROLLING)


@query(O.with_(O.PANEL, O.folds(B.OFF_GRID), O.scaffold(align=False)) + "SELECT * FROM hist")
def scaffold_off_grid(spark, sf_dir):
    return scaffold.scaffold_actuals(B.prepared_panel(spark, sf_dir), B.OFF_GRID, align=False)


# --- scoring -------------------------------------------------------------------------

@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE) + "SELECT * FROM forecasts")
def seasonal_naive(spark, sf_dir):
    return baseline.seasonal_naive(B.core_panel(spark, sf_dir), B.ROLLING)


@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.scaffold(),
               O.dashboard("seasonal_naive", RUN)) + "SELECT * FROM dashboard")
def dashboard_rows(spark, sf_dir):
    return backtest.seasonal_naive_rows(B.prepared_panel(spark, sf_dir), B.ROLLING, RUN)


@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.scaffold(),
               O.dashboard("seasonal_naive", RUN)) + f"""
SELECT fold, CAST(round(CAST(({O.WMAPE}) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE FROM dashboard GROUP BY fold""")
def seasonal_naive_wmape(spark, sf_dir):
    return rounded(backtest.seasonal_naive_wmape(B.prepared_panel(spark, sf_dir), B.ROLLING), "wMAPE")


@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.eval_rows())
       + "SELECT * REPLACE (CAST(round(CAST((wMAPE) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE) FROM eval")
def eval_rows(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    rows = score.eval_rows(panel, baseline.seasonal_naive(panel, B.ROLLING), B.ROLLING)
    return rounded(rows, "wMAPE")


@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.eval_rows()) + f"""
SELECT fold, CAST(round(CAST(({O.WMAPE}) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE FROM eval
WHERE period >= test_start_date AND period < test_end_date AND time_series_type = 'forecast'
GROUP BY fold""")
def global_wmape(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    rows = score.eval_rows(panel, baseline.seasonal_naive(panel, B.ROLLING), B.ROLLING,
                           test_only=True)
    return rounded(score.global_wmape(rows), "wMAPE")


@query(O.with_(O.PANEL, O.folds(B.EARLY), O.SEASONAL_NAIVE, O.eval_rows()) + f"""
SELECT fold, CAST(round(CAST(({O.WMAPE}) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE FROM eval
WHERE period >= test_start_date AND period < test_end_date
  AND (time_series_type = 'forecast' OR time_series_type IS NULL)
GROUP BY fold""")
def global_wmape_with_cold(spark, sf_dir):
    panel = B.prepared_panel(spark, sf_dir)
    rows = score.eval_rows(panel, baseline.seasonal_naive(panel, B.EARLY), B.EARLY,
                           test_only=True)
    return rounded(score.global_wmape(rows, with_cold_starts=True), "wMAPE")


FULL_SQL = O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.FULL_EVAL)


@query(FULL_SQL + "SELECT * FROM full_eval")
def eval_rows_full(spark, sf_dir):
    """Actuals and forecasts in full: also the forecasts that no actual met."""
    panel = B.prepared_panel(spark, sf_dir)
    return score.full_eval_rows(panel, baseline.seasonal_naive(panel, B.ROLLING), B.ROLLING)


@query(FULL_SQL + f"""
SELECT fold, {O.rounded('wMAPE, MAPE, MAE, pMAE, MSE, RMSE, pRMSE')}, n_both, n_actual, n_forecast
FROM (SELECT fold, {O.SUITE}, count(*) FILTER (side = 'both') AS n_both,
             count(*) FILTER (side = 'actual') AS n_actual,
             count(*) FILTER (side = 'forecast') AS n_forecast
      FROM (SELECT * REPLACE (coalesce(actual_value, 0) AS actual_value) FROM full_eval)
      WHERE period >= test_start_date AND period < test_end_date GROUP BY fold)""")
def full_metrics(spark, sf_dir):
    return rounded(score.full_metrics(eval_rows_full(spark, sf_dir)), "wMAPE", "MAPE", "MAE",
                   "pMAE", "MSE", "RMSE", "pRMSE")


# The clamp and the lag index on a forecast that can be negative or missing: the week's
# quantity less twelve, NULL on a zero covariate.
SIGNED = f"""signed AS (
  SELECT series, period, qty, CASE WHEN {O.rain('period')} > 0 THEN qty - 12.0 END
         AS forecast_value FROM panel)"""


def _signed(spark, sf_dir):
    rain = B.rain("period")
    return B.origin_panel(spark, sf_dir).withColumn(
        "forecast_value", F.when(rain > 0, F.col("qty") - F.lit(12.0)))


@query(O.with_(O.ORIGIN, SIGNED) + f"""
SELECT series, period, qty, CAST(forecast_value AS DOUBLE) AS forecast_value,
       CAST({O.clamp('forecast_value')} AS DOUBLE) AS forecast_value_filled FROM signed""")
def clamp_forecast(spark, sf_dir):
    return _signed(spark, sf_dir).withColumn("forecast_value_filled", C.clamp("forecast_value"))


@query(O.with_(O.PANEL, O.folds(B.OFF_GRID)) + """
SELECT p.series, p.period, f.fold,
       round(date_diff('day', f.test_start_date, p.period) / 7.0) AS lag
FROM panel p JOIN folds f ON p.period >= f.test_start_date AND p.period < f.test_end_date""")
def lag_index(spark, sf_dir):
    period = F.col("period")
    rows = folds.fan_out(B.core_panel(spark, sf_dir), B.OFF_GRID, lambda f: (
        period >= f["test_start_date"]) & (period < f["test_end_date"]))
    return rows.select("series", "period", F.col("f.fold").alias("fold"), C.lag_index(
        "period", F.col("f.test_start_date"), "WEEKLY").alias("lag"))


@query(O.with_(O.DAILY, """folds AS (
  SELECT CAST(0 AS INTEGER) AS fold, DATE '2024-01-16' AS test_start_date,
         DATE '2024-01-30' AS test_end_date)""", O.scaffold(days=1), """forecasts AS (
  SELECT f.fold, p.series, CAST(p.period + 14 AS DATE) AS period,
         'forecast' AS time_series_type, CAST(p.qty AS DOUBLE) AS forecast_value,
         CAST(NULL AS DOUBLE) AS prediction_interval_lower_bound,
         CAST(NULL AS DOUBLE) AS prediction_interval_upper_bound
  FROM panel p JOIN folds f ON p.period < f.test_start_date
   AND p.period + 14 >= f.test_start_date AND p.period + 14 < f.test_end_date)""",
               O.dashboard("seasonal_naive", RUN, days=1)) + "SELECT * FROM dashboard")
def dashboard_rows_daily(spark, sf_dir):
    panel = B.daily_panel(spark, sf_dir)
    rolling = folds.Rolling("2024-01-01", "2024-01-16", "2024-01-16", horizon=2)
    forecasts = baseline.seasonal_naive(panel, rolling, season_days=14)
    return score.dashboard_rows(panel, forecasts, rolling, "seasonal_naive", RUN,
                                granularity="DAILY")


@query(O.with_(O.PANEL, O.labelled(B.ROLLING)) + f"""
SELECT '{RUN}-fold-' || fold AS run_name, '{RUN}' AS run_id, fold, count(*) AS n_rows
FROM labelled GROUP BY fold""")
def run_id(spark, sf_dir):
    counts = folds.count_splits(B.core_panel(spark, sf_dir), B.ROLLING)
    return (counts.groupBy("fold").agg(F.sum("n_rows").alias("n_rows"))
            .withColumn("run_name", C.fold_run_name(RUN, "fold"))
            .withColumn("run_id", C.run_id("run_name")))


# --- time-series analysis ------------------------------------------------------------

DECOMPOSED = "SELECT series, period, qty, " + O.rounded("trend, seasonal, resid") + \
    " FROM decomposed"


@query(O.with_(O.TOTAL, O.decompose()) + DECOMPOSED)
def seasonal_decompose(spark, sf_dir):
    return rounded(decompose.seasonal_decompose(B.total_panel(spark, sf_dir)),
                   "trend", "seasonal", "resid")


@query(O.with_(O.DENSE_ORIGIN, O.decompose("additive")) + DECOMPOSED)
def seasonal_decompose_additive(spark, sf_dir):
    panel = P.fill_gaps(B.origin_panel(spark, sf_dir))
    return rounded(decompose.seasonal_decompose(panel, model="additive"),
                   "trend", "seasonal", "resid")


@query(O.with_(O.DENSE.replace("\npanel AS", "\ndense AS"), """panel AS (
  SELECT series, period, CASE WHEN qty = 0 THEN 0.01 ELSE CAST(qty AS DOUBLE) END AS qty
  FROM dense)""", O.decompose()) + DECOMPOSED)
def seasonal_decompose_zero_replaced(spark, sf_dir):
    panel = P.fill_gaps(B.core_panel(spark, sf_dir), end=B.LAST_PERIOD)
    return rounded(decompose.seasonal_decompose(panel, zero_by=C.MULTIPLICATIVE_ZERO),
                   "trend", "seasonal", "resid")


@query(O.with_(O.TOTAL, O.decompose(), O.TYPICAL) + """
SELECT series, week_of_year, CAST(round(CAST((seasonal) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS seasonal FROM profile""")
def typical_seasonality(spark, sf_dir):
    return rounded(_profile(B.total_panel(spark, sf_dir)), "seasonal")


def _profile(panel):
    return decompose.typical_seasonality(decompose.seasonal_decompose(panel))


@query(O.with_(O.TOTAL, O.decompose(), O.TYPICAL, O.lowess(iters=0)) + "SELECT * FROM smooth")
def lowess_profile(spark, sf_dir):
    return rounded(lowess.lowess(_profile(B.total_panel(spark, sf_dir)), iters=0),
                   "seasonal", "smoothed")


@query(O.with_(O.TOTAL, O.decompose(), O.TYPICAL, O.lowess(iters=3)) + "SELECT * FROM smooth")
def lowess_robust(spark, sf_dir):
    return rounded(lowess.lowess(_profile(B.total_panel(spark, sf_dir))),
                   "seasonal", "smoothed")


@query(O.with_(O.DENSE_ORIGIN, O.decompose(), O.TYPICAL, O.lowess(iters=3)) + "SELECT * FROM smooth")
def lowess_by_series(spark, sf_dir):
    panel = P.fill_gaps(B.origin_panel(spark, sf_dir))
    return rounded(lowess.lowess(_profile(panel)), "seasonal", "smoothed")


# --- holidays ------------------------------------------------------------------------

@query(O.with_(O.BOUNDS, O.holidays("first_period", "last_period", "bounds"))
       + "SELECT * FROM holidays")
def holiday_calendar(spark, sf_dir):
    return holiday.holiday_calendar(B.event_bounds(spark, sf_dir), F.col("first_period"),
                                    F.col("last_period"))


@query(O.with_(O.DENSE_ORIGIN, O.decompose(), O.BOUNDS,
               O.holidays("first_period", "last_period", "bounds")) + """
SELECT d.series, h.holiday, CAST(round(CAST((avg(qty / nullif(trend, 0))) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS holiday_effect,
       count(trend) AS n_periods
FROM decomposed d JOIN (SELECT DISTINCT period, holiday FROM holidays) h ON d.period = h.period
GROUP BY 1, 2""")
def holiday_effects(spark, sf_dir):
    panel = P.fill_gaps(B.origin_panel(spark, sf_dir))
    effects = holiday.holiday_effects(decompose.seasonal_decompose(panel),
                                      holiday_calendar(spark, sf_dir))
    return rounded(effects, "holiday_effect")


# --- ARIMA ---------------------------------------------------------------------------

ARIMA_SQL = O.with_(O.PANEL, ROLL, O.holiday_periods(B.ROLLING), O.arima_grid(B.ROLLING),
                    O.arima())
BOUNDS = ["forecast_value", "prediction_interval_lower_bound", "prediction_interval_upper_bound"]
COMPONENTS = ["time_series_data", "standard_error", "trend", "seasonal", "holiday_effect",
              "regressor_effect"]
ONE_SERIES = "nation3_nation15"


def _holidays(spark):
    """Holidays over all the dates that any fold can reach."""
    return holiday.holiday_calendar(spark.range(1), B.ROLLING.train_start,
                                    B.ROLLING.last_day())


def _arima_grid(spark, sf_dir, panel=None):
    panel = B.core_panel(spark, sf_dir) if panel is None else panel
    return arima.fold_grid(panel, B.ROLLING, holidays=_holidays(spark))


def _arima(spark, sf_dir, panel=None):
    return arima.fit(_arima_grid(spark, sf_dir, panel))


@query(ARIMA_SQL + ", " + O.arima_forecast(0.9) + O.FORECAST)
def arima_closed_form(spark, sf_dir):
    return rounded(arima.forecast(_arima(spark, sf_dir), 0.9), *BOUNDS, digits=6)


@query(ARIMA_SQL + ", " + O.arima_forecast(0.9, lower=0.5) + O.FORECAST)
def forecast_limits(spark, sf_dir):
    return rounded(arima.forecast(_arima(spark, sf_dir), 0.9, lower=0.5), *BOUNDS, digits=6)


@query(ARIMA_SQL + O.EXPLAINED)
def explain_forecast(spark, sf_dir):
    return rounded(arima.explain(_arima(spark, sf_dir)), *BOUNDS, *COMPONENTS, digits=6)


@query(ARIMA_SQL + ", " + O.SPIKES + "SELECT * FROM adjusted")
def adjusted_history(spark, sf_dir):
    """Spikes and dips of every history, and what is left without them."""
    rows = arima.remove_effects(_arima_grid(spark, sf_dir))
    found = adjust.spikes_and_dips(rows, ["series", "fold"], "period").filter(
        F.col("time_series_type") == "history")
    found = found.select("fold", "series", "period", "actual", "spikes_and_dips", (
        F.col("actual") - F.col("spikes_and_dips")).alias("cleaned"))
    return rounded(found, "spikes_and_dips", "cleaned", digits=6)


@query()
def explain_adjusted(spark, sf_dir):
    """Closed-form models on adjusted history, with spikes, dips and step changes told."""
    fitted = arima.fit(_arima_grid(spark, sf_dir), adjusted=True)
    return rounded(arima.explain(fitted), *BOUNDS, *COMPONENTS, *adjust.COLUMNS, digits=6)


@query(ARIMA_SQL + O.EXPLAINED + f""" WHERE series = '{ONE_SERIES}' AND fold = 3
ORDER BY period DESC LIMIT 5""")
def explain_one_series(spark, sf_dir):
    one = explain_forecast(spark, sf_dir).filter(
        (F.col("series") == ONE_SERIES) & (F.col("fold") == 3))
    return tables.preview(one, [F.desc("period")], 5)


@query(ARIMA_SQL + """
SELECT fold, series, p, d, CAST(0 AS INTEGER) AS q, n AS n_rows,
       CASE WHEN p = 1 THEN CAST(round(CAST((phi) AS DECIMAL(28, 10)), 6) AS DOUBLE) END AS ar_1, CAST(round(CAST((c) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS intercept_or_drift,
       CAST(round(CAST((coalesce(sse / nullif(m, 0), 0.0)) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS variance, """
       + O.rounded("sse, aic, kpss", 6) + " FROM models")
def arima_coefficients(spark, sf_dir):
    models = arima.coefficients(_arima(spark, sf_dir))
    flat = models.withColumn("ar_1", F.get("ar_coefficients", F.lit(0))).drop(
        "ar_coefficients", "ma_coefficients")
    return rounded(flat, "ar_1", "intercept_or_drift", "variance", "sse", "aic", "kpss",
                   digits=6)


@query(ARIMA_SQL + """
SELECT fold, count(*) AS n_series, CAST(sum(n) AS BIGINT) AS n_rows, CAST(round(CAST((sum(sse)) AS DECIMAL(28, 8)), 4) AS DOUBLE) AS sse,
       CAST(round(CAST((avg(aic)) AS DECIMAL(28, 8)), 4) AS DOUBLE) AS mean_aic,
       count(*) FILTER (p = 0 AND d = 0) AS n_order_0_0_0,
       count(*) FILTER (p = 1 AND d = 0) AS n_order_1_0_0,
       count(*) FILTER (p = 0 AND d = 1) AS n_order_0_1_0,
       count(*) FILTER (p = 1 AND d = 1) AS n_order_1_1_0
FROM models GROUP BY fold""")
def training_info(spark, sf_dir):
    info = arima.training_info(arima.coefficients(_arima(spark, sf_dir)))
    return rounded(info, "sse", "mean_aic", digits=4)


# --- baselines, reports --------------------------------------------------------------

GRID_SQL = [O.PANEL, ROLL, O.NO_HOLIDAYS, O.arima_grid(B.ROLLING)]
R3_SQL = O.arima().split("he AS (")[0].rstrip(",\n ")
PLAIN = "SELECT fold, series, period, time_series_type, CAST(round(CAST((forecast_value) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS " \
    "forecast_value, prediction_interval_lower_bound, prediction_interval_upper_bound FROM "


@query(O.with_(*GRID_SQL, O.DRIFT) + PLAIN + "drift")
def drift_forecast(spark, sf_dir):
    return rounded(baseline.drift(B.core_panel(spark, sf_dir), B.ROLLING), "forecast_value",
                   digits=6)


@query(O.with_(*GRID_SQL, R3_SQL, O.TREND_SEASON) + PLAIN + "trend_season")
def trend_season_forecast(spark, sf_dir):
    return rounded(baseline.trend_season(B.core_panel(spark, sf_dir), B.ROLLING),
                   "forecast_value", digits=6)


BOARDS_SQL = O.with_(
    *GRID_SQL, R3_SQL, O.scaffold(), O.SEASONAL_NAIVE, O.DRIFT, O.TREND_SEASON,
    O.dashboard_of("seasonal_naive", RUN, "forecasts"), O.dashboard_of("drift", RUN, "drift"),
    O.dashboard_of("trend_season", RUN, "trend_season"), """boards AS (
  SELECT * FROM board_seasonal_naive UNION ALL SELECT * FROM board_drift
  UNION ALL SELECT * FROM board_trend_season)""")
TWO_BOARDS_SQL = O.materialized(O.with_(
    *GRID_SQL, O.scaffold(), O.SEASONAL_NAIVE, O.DRIFT,
    O.dashboard_of("seasonal_naive", RUN, "forecasts"), O.dashboard_of("drift", RUN, "drift")),
    "panel", "folds", "grid", "r0", "scaffold", "hist", "forecasts", "drift")
BOARD_COLUMNS = ("SELECT period, series, actualQty, predicted_p10, predicted_p90, model_name, "
                 "run_id, fold, lag, wHist, "
                 + O.rounded("forecastQty, diff, wAbsError", 6))


def _baselines(panel):
    return {"seasonal_naive": baseline.seasonal_naive(panel, B.ROLLING),
            "drift": baseline.drift(panel, B.ROLLING),
            "trend_season": baseline.trend_season(panel, B.ROLLING)}


def _two_boards(spark, sf_dir):
    """Dashboard rows of two baselines, one DataFrame each."""
    panel = B.prepared_panel(spark, sf_dir)
    models = _baselines(panel)
    return [score.dashboard_rows(panel, models[name], B.ROLLING, name, RUN)
            for name in ("seasonal_naive", "drift")]


def _all_boards(spark, sf_dir):
    """Dashboard rows of the three baselines over one scaffold."""
    panel = B.prepared_panel(spark, sf_dir)
    return score.compare_models(panel, _baselines(panel), B.ROLLING, RUN)


@query(BOARDS_SQL + f"""
SELECT model_name, run_id, fold, CAST(round(CAST(w AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE,
       CAST(row_number() OVER (PARTITION BY fold ORDER BY w NULLS LAST, model_name) AS INTEGER)
         AS model_rank
FROM (SELECT model_name, run_id, fold, {O.WMAPE} AS w FROM boards GROUP BY 1, 2, 3)""")
def model_leaderboard(spark, sf_dir):
    return rounded(report.model_leaderboard(_all_boards(spark, sf_dir)), "wMAPE")


@query(BOARDS_SQL + f"""
SELECT model_name, run_id, lag, CAST(round(CAST(({O.WMAPE}) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS wMAPE FROM boards GROUP BY 1, 2, 3""")
def wmape_by_lag(spark, sf_dir):
    return rounded(report.wmape_by_lag(_all_boards(spark, sf_dir)), "wMAPE")


DECISION_LAGS = B.ROLLING.horizon - 1


@query(BOARDS_SQL + f""", losses AS (
  SELECT model_name, period, coalesce(CAST(sum(wAbsError) AS DOUBLE), 0.0) AS loss FROM boards GROUP BY 1, 2),
pairs AS (
  SELECT m.model_name AS challenger, m.period, c.loss - m.loss AS d
  FROM losses m JOIN losses c ON c.period = m.period AND c.model_name = 'seasonal_naive'
  WHERE m.model_name <> 'seasonal_naive'),
centred AS (
  SELECT *, d - avg(d) OVER (PARTITION BY challenger) AS e,
         row_number() OVER (PARTITION BY challenger ORDER BY period) AS t FROM pairs),
products AS (
  SELECT a.challenger, sum(a.e * b.e * CASE WHEN a.t = b.t THEN 1.0 ELSE
         2.0 * (1 - (a.t - b.t) / {DECISION_LAGS + 1}.0) END) AS total
  FROM centred a JOIN centred b
    ON a.challenger = b.challenger AND b.t BETWEEN a.t - {DECISION_LAGS} AND a.t GROUP BY 1),
tests AS (
  SELECT challenger, count(*) AS n_periods, avg(d) AS mean_difference,
         sqrt(any_value(total)) / count(*) AS standard_error
  FROM centred JOIN products USING (challenger) GROUP BY 1)
SELECT 'seasonal_naive' AS champion, challenger, n_periods,
       {O.rounded('mean_difference, standard_error, statistic', 4)},
       CASE WHEN statistic > {C.z_value(0.95)!r} THEN 'challenger'
            WHEN statistic < -{C.z_value(0.95)!r} THEN 'champion' ELSE 'undecided' END AS decision
FROM (SELECT *, mean_difference / standard_error AS statistic FROM tests)""")
def champion_test(spark, sf_dir):
    """Drift and trend with season against the seasonal-naive champion."""
    found = report.champion_test(_all_boards(spark, sf_dir), "seasonal_naive", DECISION_LAGS)
    return rounded(found, "mean_difference", "standard_error", "statistic", digits=4)


@query(TWO_BOARDS_SQL + BOARD_COLUMNS + """
FROM (SELECT * FROM board_seasonal_naive UNION ALL SELECT * FROM board_drift)""")
def dashboard_append(spark, sf_dir):
    path = scratch.scratch_path(spark, "dashboard")
    for rows in _two_boards(spark, sf_dir):
        tables.append_table(rows, path)
    return rounded(tables.read_appended(spark, path), "forecastQty", "diff", "wAbsError",
                   digits=6)


@query(TWO_BOARDS_SQL + BOARD_COLUMNS + """, percentage_rain
FROM (SELECT *, CAST(NULL AS DOUBLE) AS percentage_rain FROM board_seasonal_naive
      UNION ALL BY NAME
      SELECT *, """ + O.rain("period") + """ AS percentage_rain FROM board_drift)""")
def dashboard_merge_schema(spark, sf_dir):
    path = scratch.scratch_path(spark, "dashboard")
    first, second = _two_boards(spark, sf_dir)
    tables.append_table(first, path)
    tables.append_table(second.withColumn("percentage_rain", B.rain("period")), path)
    return rounded(tables.read_appended(spark, path), "forecastQty", "diff", "wAbsError",
                   digits=6)


@query(ORACLES["dashboard_merge_schema"])
def dashboard_union_new_columns(spark, sf_dir):
    first, second = _two_boards(spark, sf_dir)
    both = tables.union_allow_new_columns(
        first, second.withColumn("percentage_rain", B.rain("period")))
    return rounded(both, "forecastQty", "diff", "wAbsError", digits=6)


@query(ORACLES["dashboard_rows"])
def dashboard_resumed(spark, sf_dir):
    """A run that is stopped after four folds and taken up again, three folds at a time."""
    panel = cut_lineage(B.prepared_panel(spark, sf_dir), "panel")
    root = scratch.scratch_path(spark, "resumed")

    def run(**options):
        return R.resume(panel, B.ROLLING, RUN, "seasonal_naive", baseline.seasonal_naive, root,
                        **options)

    run(most=4)
    return run(at_once=3)


@query(O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.scaffold(), O.dashboard("seasonal_naive", "baseline")) + f"""
, scores AS (SELECT fold, round({O.WMAPE}, 6) AS w FROM dashboard GROUP BY fold)
SELECT '{RUN}-fold-' || fold AS run_name, k AS name, v AS value FROM (
  SELECT fold, 'data_frequency' AS k, 'WEEKLY' AS v FROM scores
  UNION ALL SELECT fold, 'horizon', '{B.ROLLING.horizon}' FROM scores
  UNION ALL SELECT fold, 'model_type', 'seasonal_naive' FROM scores
  UNION ALL SELECT fold, 'wMAPE', CAST(CAST(w AS DECIMAL(18, 6)) AS VARCHAR) FROM scores)""")
def run_log(spark, sf_dir):
    scores = seasonal_naive_wmape(spark, sf_dir).withColumn(
        "run_name", C.fold_run_name(RUN, "fold"))
    params = {"model_type": "seasonal_naive", "horizon": B.ROLLING.horizon,
              "data_frequency": "WEEKLY"}
    log = tables.run_log(scores, "run_name", params, ["wMAPE"])
    metrics = F.transform_values("metrics", lambda _, v: v.cast("decimal(18,6)").cast("string"))
    return log.select("run_name", F.explode(F.map_concat("params", metrics)).alias("name", "value"))


# --- regressors ----------------------------------------------------------------------

XREG_SQL = O.with_(O.PANEL, ROLL, O.holiday_periods(B.ROLLING), O.arima_grid(B.ROLLING),
                   O.arima(regression=True)) + ", " + O.arima_forecast(0.9) + O.FORECAST


def _covariates(spark):
    """The covariate over all the dates that any fold can reach."""
    spine = P.period_spine(spark.range(1), B.ROLLING.train_start, B.ROLLING.last_day())
    return spine.withColumn("percentage_rain", B.rain("period"))


@query(XREG_SQL)
def xreg_one_covariate(spark, sf_dir):
    grid = arima.fold_grid(B.core_panel(spark, sf_dir), B.ROLLING, _covariates(spark),
                           ["percentage_rain"], _holidays(spark))
    fitted = arima.fit(xreg.remove_one(grid, "percentage_rain"))
    return rounded(arima.forecast(fitted, 0.9), *BOUNDS, digits=6)


# Attributes are constant within a series, so the intercept absorbs them and the twin of
# the many-covariate model is the one-covariate model.
@query(XREG_SQL)
def xreg_multi(spark, sf_dir):
    grid = arima.fold_grid(B.weekly_panel(spark, sf_dir), B.ROLLING, _covariates(spark),
                           ["percentage_rain"], _holidays(spark), attributes=B.ATTRIBUTES)
    fitted = arima.fit(xreg.remove_many(grid, ["percentage_rain", *B.ATTRIBUTES]))
    return rounded(arima.forecast(fitted, 0.9), *BOUNDS, digits=6)


# --- automatic orders ----------------------------------------------------------------

@query()
def arima_auto(spark, sf_dir):
    grid = arima.fold_grid(B.core_panel(spark, sf_dir), B.ROLLING, holidays=_holidays(spark))
    models = auto_arima.fit(grid, B.ROLLING.horizon)
    return rounded(auto_arima.forecast(models, 0.9), *BOUNDS, "standard_error", digits=6)


@query()
def arima_auto_models(spark, sf_dir):
    grid = arima.fold_grid(B.core_panel(spark, sf_dir), B.ROLLING, holidays=_holidays(spark))
    return auto_arima.coefficients(auto_arima.fit(grid, B.ROLLING.horizon))


@query()
def arima_auto_explain(spark, sf_dir):
    return rounded(backtest.arima_forecasts(
        B.core_panel(spark, sf_dir), B.ROLLING, holiday_regions=["GLOBAL", "US"]),
        *BOUNDS, *COMPONENTS, digits=6)


@query()
def arima_auto_adjusted(spark, sf_dir):
    """The same on adjusted history, with spikes, dips and step changes told."""
    return rounded(backtest.arima_forecasts(
        B.core_panel(spark, sf_dir), B.ROLLING, holiday_regions=["GLOBAL", "US"],
        adjusted=True), *BOUNDS, *COMPONENTS, *adjust.COLUMNS, digits=6)


@query()
def arima_auto_training_info(spark, sf_dir):
    grid = arima.fold_grid(B.core_panel(spark, sf_dir), B.ROLLING, holidays=_holidays(spark))
    return auto_arima.training_info(auto_arima.fit(grid, B.ROLLING.periods()))


def _gap_models(spark, sf_dir):
    grid = arima.fold_grid(B.core_panel(spark, sf_dir), B.ROLLING, holidays=_holidays(spark),
                           fill="none")
    return gaps.fit(grid, B.ROLLING.horizon)


@query()
def arima_gaps(spark, sf_dir):
    """Periods without a row are unknown, not 0: exact likelihood over what is known."""
    return rounded(auto_arima.forecast(_gap_models(spark, sf_dir), 0.9), *BOUNDS,
                   "standard_error", digits=6)


@query()
def arima_gaps_models(spark, sf_dir):
    return gaps.coefficients(_gap_models(spark, sf_dir))


# --- pooled models -------------------------------------------------------------------

CONTEXT = 20
EXAMPLES_END = f"DATE '{B.LAST_PERIOD}' + 7"


@query(O.with_(O.DENSE_ORIGIN, O.window_examples(CONTEXT, B.ROLLING.horizon, EXAMPLES_END))
       + "SELECT * FROM examples")
def window_examples(spark, sf_dir):
    panel = cut_lineage(P.fill_gaps(B.origin_panel(spark, sf_dir)), "origins")
    return pooled.window_examples(
        panel, CONTEXT, B.ROLLING.periods(),
        known=B.weather(spark, sf_dir, panel)).filter("target IS NOT NULL")


def _examples(spark, sf_dir):
    """Examples of every series of the weekly panel, with all four attributes."""
    panel = B.weekly_panel(spark, sf_dir).select("series", "period", "qty", *B.ATTRIBUTES)
    return pooled.prepared_examples(panel, B.ROLLING, CONTEXT, known=_covariates(spark),
                                    attributes=B.ATTRIBUTES, holidays=_holidays(spark))


def _dense(spark, sf_dir):
    """Dense forecasts of all series, refitted for every fold."""
    panel = B.weekly_panel(spark, sf_dir).select("series", "period", "qty", *B.ATTRIBUTES)
    return pooled.fit_and_forecast(
        panel, B.ROLLING, "dense_encoder", CONTEXT, known=_covariates(spark),
        attributes=B.ATTRIBUTES, holidays=_holidays(spark))


# What a pooled model forecasts is known without it: every test week of every fold for
# every series that has a full context before the fold.
POOLED_SQL = O.with_(O.PANEL, ROLL) + f"""
SELECT f.fold, s.series, count(*) AS n_rows, min(w.period) AS first_period,
       max(w.period) AS last_period, 0::BIGINT AS n_missing
FROM (SELECT series, min(period) AS since FROM panel GROUP BY 1) s
JOIN folds f ON s.since <= f.test_start_date - 7 * {CONTEXT}
JOIN (SELECT CAST(unnest(generate_series(DATE '{B.FIRST_PERIOD}', DATE '{B.LAST_PERIOD}'
        + 7 * {B.ROLLING.horizon}, INTERVAL 7 DAY)) AS DATE) AS period) w
  ON w.period >= f.test_start_date AND w.period < f.test_end_date
GROUP BY f.fold, s.series"""


def _coverage(forecasts):
    return forecasts.groupBy("fold", "series").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.count_if(F.col("forecast_value").isNull()).alias("n_missing"))


@query(POOLED_SQL)
def global_linear_coverage(spark, sf_dir):
    return _coverage(_dense(spark, sf_dir))


def _boosted(spark, sf_dir):
    """Boosted trees over all series, for all folds together."""
    panel = B.weekly_panel(spark, sf_dir).select("series", "period", "qty", *B.ATTRIBUTES)
    return pooled.fit_and_forecast(
        panel, B.ROLLING, "learn_to_learn", CONTEXT, known=_covariates(spark),
        attributes=B.ATTRIBUTES, holidays=_holidays(spark))


@query()
def global_gbt(spark, sf_dir):
    return _boosted(spark, sf_dir)


@query(POOLED_SQL)
def global_gbt_coverage(spark, sf_dir):
    return _coverage(_boosted(spark, sf_dir))


@query()
def global_linear(spark, sf_dir):
    return _dense(spark, sf_dir)


@query()
def global_linear_models(spark, sf_dir):
    """Coefficients, spread and iterations of every fold's model for every step ahead."""
    return rounded(pooled.dense_models(*_examples(spark, sf_dir), B.ROLLING),
                   "intercept", "sigma", digits=6)


# With the mean of the context as its only input a head is a simple regression.
@query(O.with_(O.PANEL, ROLL) + f""", since AS (SELECT series, min(period) AS first FROM panel GROUP BY 1),
dense AS (
  SELECT s.series, w.period, coalesce(p.qty, 0) AS qty
  FROM (SELECT series, CAST(unnest(generate_series(first, DATE '{B.LAST_PERIOD}'
          + 7 * {B.ROLLING.horizon}, INTERVAL 7 DAY)) AS DATE) AS period FROM since) w
  JOIN since s USING (series) LEFT JOIN panel p ON p.series = s.series AND p.period = w.period),
origins AS (
  SELECT series, period AS origin, avg(qty) OVER k AS level, count(*) OVER k AS n
  FROM dense WINDOW k AS (PARTITION BY series ORDER BY period ROWS {CONTEXT - 1} PRECEDING)),
examples AS (
  SELECT o.series, o.origin, o.level, h.h, CAST(o.origin + 7 * h.h AS DATE) AS period, d.qty AS target
  FROM origins o CROSS JOIN (SELECT CAST(unnest(generate_series(1, {B.ROLLING.horizon})) AS INTEGER) AS h) h
  LEFT JOIN dense d ON d.series = o.series AND d.period = o.origin + 7 * h.h
  WHERE o.n = {CONTEXT}),
heads AS (
  SELECT f.fold, e.h, covar_pop(e.target, e.level) / var_pop(e.level) AS slope,
         avg(e.target) AS my, avg(e.level) AS mx
  FROM examples e JOIN folds f ON e.period < f.test_start_date WHERE e.target IS NOT NULL GROUP BY 1, 2)
SELECT fold, series, period, {O.rounded('forecast_value', 4)}
FROM (SELECT f.fold, e.series, e.period, h.my + h.slope * (e.level - h.mx) AS forecast_value
      FROM examples e JOIN folds f ON e.origin < f.test_start_date AND e.origin + 7 >= f.test_start_date
      JOIN heads h ON h.fold = f.fold AND h.h = e.h)""")
def global_least_squares(spark, sf_dir):
    """The dense model with squared errors and the context's mean as its only input."""
    examples, _ = _examples(spark, sf_dir)
    lags = [F.col(f"lag_{i}") for i in range(1, CONTEXT + 1)]
    level = sum(lags[1:], lags[0]) / CONTEXT
    examples = examples.withColumns({"level": level, "h": F.col("h").cast("int")})
    models = dense.fit(examples, ["level"], B.ROLLING, loss="squared")
    found = dense.forecast(examples, models, ["level"], B.ROLLING, 7)
    return rounded(found.select("fold", "series", "period", "forecast_value"),
                   "forecast_value", digits=4)


ITEMS_SQL = O.with_(O.PANEL, ROLL, O.SEASONAL_NAIVE, O.ITEMS)


def _items(spark, sf_dir):
    """Seasonal-naive forecasts in the shape pooled models export: each test row once
    per day it was predicted on, target as text, prediction as a struct."""
    panel = B.prepared_panel(spark, sf_dir)
    tested = folds.fan_out(panel, B.ROLLING, lambda f: (
        F.col("period") >= f["test_start_date"]) & (F.col("period") < f["test_end_date"]))
    tested = tested.select("series", "period", F.col("f.fold").alias("fold"),
                           F.col("f.test_start_date").alias("test_start_date"),
                           "origin_id", "dest_id", F.col("qty").cast("string").alias("qty"))
    ahead = baseline.seasonal_naive(panel, B.ROLLING).select(
        "fold", "series", "period", "forecast_value")
    items = tested.join(ahead, ["fold", "series", "period"], "left")
    items = items.withColumn("predicted_on_period", F.explode(F.array(
        *[F.date_sub("period", back) for back in (0, 7, 14)])))
    return score.to_evaluated_items(items, "forecast_value")


@query(ITEMS_SQL + """
SELECT fold, series, period, predicted_on_period, qty, predicted_qty, origin_id, dest_id
FROM items""")
def evaluated_items(spark, sf_dir):
    path = scratch.scratch_path(spark, "items")
    stored = tables.replace_table(_items(spark, sf_dir), path, cluster_by=["series", "period"])
    return stored.select("fold", "series", "period", "predicted_on_period", "qty",
                         F.col("predicted_qty.value").alias("predicted_qty"), "origin_id",
                         "dest_id")


@query(ITEMS_SQL + f"""
SELECT period, predicted_on_period, CAST(qty AS DOUBLE) AS actual_qty, series, predicted_qty,
       origin_id, dest_id, 'l2l_context20_demand_{RUN}-fold-' || fold AS model_name,
       '{RUN}' AS run_id, fold, round(date_diff('day', test_start_date, period) / 7.0) AS lag,
       CAST(qty AS DOUBLE) - predicted_qty AS diff,
       abs(CAST(qty AS DOUBLE) - predicted_qty) * CAST(qty AS DOUBLE) AS wAbsError,
       CAST(qty AS DOUBLE) * CAST(qty AS DOUBLE) AS wHist
FROM items WHERE period = predicted_on_period""")
def pooled_dashboard_rows(spark, sf_dir):
    name = C.global_model_name("learn_to_learn", CONTEXT, "demand",
                               C.fold_run_name(RUN, "fold"))
    return score.evaluated_dashboard_rows(
        _items(spark, sf_dir), name, RUN, F.col("test_start_date"),
        carry=["origin_id", "dest_id"])


@query(ITEMS_SQL + ", " + O.evaluated() + "SELECT * FROM errors")
def pooled_eval_rows(spark, sf_dir):
    return score.evaluated_errors(_items(spark, sf_dir))


SUITE = ["wMAPE", "MAPE", "MAE", "pMAE", "MSE", "RMSE", "pRMSE"]
SUITE_SQL = f"""
SELECT fold, time_series_type, {O.rounded(', '.join(SUITE))}
FROM (SELECT fold, time_series_type, {O.SUITE} FROM errors GROUP BY fold, time_series_type)"""


@query(ITEMS_SQL + ", " + O.evaluated() + SUITE_SQL)
def metric_suite(spark, sf_dir):
    return rounded(score.metric_suite(score.evaluated_errors(_items(spark, sf_dir))), *SUITE)


@query(ITEMS_SQL + ", " + O.evaluated(clamped=True) + SUITE_SQL)
def metric_suite_clamped(spark, sf_dir):
    errors = score.evaluated_errors(_items(spark, sf_dir), clamp_errors=True)
    return rounded(score.metric_suite(errors), *SUITE)
