"""ARIMA over histories with unknown periods, by exact likelihood.

Two-stage regression drops each row that meets an unknown lag; a state-space filter carries
the state over the gap instead. Spark takes the effects out and gathers each group's history
(bounded by the calendar) in one aggregate; a numpy filter runs a batch of groups.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from foldcast.functions import state_space
from foldcast.operators.arima import choose_difference, remove_effects
from foldcast.operators.decompose import SEASON

MODEL_TYPE = ("p int, q int, ar array<double>, ma array<double>, level_or_drift double, "
              "variance double, aic double, loglik double, mean array<double>, error array<double>")


def fit(grid: DataFrame, horizon: int, max_order: int = 2, series_col: str = "series",
        period_col: str = "period", season: int = SEASON) -> DataFrame:
    """One row per (series, fold) of a ``fold_grid`` made with ``fill="none"``: the model,
    its forecasts, and the effects to add back, as ``auto_arima.forecast`` takes them.

    ``n`` counts known periods, ``n_unknown`` the others up to the end of training. Unknown
    periods at the end widen the forecasts. With d = 1 the likelihood is that of all known
    values given the first one.
    """
    keys = [series_col, "fold"]
    rows = choose_difference(remove_effects(grid, series_col, period_col, season),
                             series_col, period_col)
    past = F.col("time_series_type") == "history"
    effects = F.col("seasonal") + F.col("holiday_effect") + F.col("regressor")
    h = F.col("t") - F.col("last_t")
    groups = rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.when(past, F.struct("t", "z")))),
                    lambda x: x["z"]).alias("history"),
        *[F.max(F.when(h == k, effects)).alias(f"effect{k}") for k in range(1, horizon + 1)],
        F.min(F.when(h == 1, F.col(period_col))).alias("first_test_period"),
        F.max("d").alias("d"), F.count("y").alias("n"))
    chosen = state_space.choose

    @pandas_udf(MODEL_TYPE)
    def model(history: pd.Series, d: pd.Series) -> pd.DataFrame:
        return chosen(history, d, max_order, horizon)

    return groups.select(
        *keys, "n", (F.size("history") - F.col("n")).alias("n_unknown"), "d",
        "first_test_period",
        F.array(*[f"effect{k}" for k in range(1, horizon + 1)]).alias("effects"),
        model("history", "d").alias("model")).select("*", "model.*").drop("model")


def coefficients(models: DataFrame, series_col: str = "series") -> DataFrame:
    return models.select(
        "fold", series_col, "p", "d", "q", F.col("ar").alias("ar_coefficients"),
        F.col("ma").alias("ma_coefficients"), "level_or_drift", "variance", "loglik", "aic",
        F.col("n").alias("n_rows"), "n_unknown")
