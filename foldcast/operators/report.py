"""Comparing models over their dashboard rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions import metrics
from foldcast.functions.columns import z_value


def model_leaderboard(rows: DataFrame) -> DataFrame:
    """wMAPE per model, run and fold, ranked within each fold (1 is best)."""
    scores = rows.groupBy("model_name", "run_id", "fold").agg(
        metrics.wmape().alias("wMAPE"))
    order = Window.partitionBy("fold").orderBy(
        F.col("wMAPE").asc_nulls_last(), "model_name", "run_id")
    return scores.withColumn("model_rank", F.row_number().over(order))


def wmape_by_lag(rows: DataFrame) -> DataFrame:
    """wMAPE per model and number of periods since the start of the test range."""
    return rows.groupBy("model_name", "run_id", "lag").agg(metrics.wmape().alias("wMAPE"))


def champion_test(rows: DataFrame, champion: str, lags: int, confidence: float = 0.95,
                  loss_col: str = "wAbsError", period_col: str = "period") -> DataFrame:
    """Whether a challenger's loss differs from the champion's: a paired test per challenger
    (Diebold-Mariano) over dashboard rows of all models.

    Losses of a period add up over series and folds, so a test sees one row per model and
    period, whatever the number of series. The variance of the mean difference takes in
    autocorrelations up to ``lags`` periods under falling weights (Newey-West), which never
    makes it negative; overlapping forecasts call for at least their horizon less one.
    A positive difference favours the challenger. Only periods that both models have count;
    NULL losses count as 0. Without variance the statistic is NULL and the decision stands on
    the difference alone: equal losses leave the champion in place.
    """
    losses = rows.groupBy("model_name", period_col).agg(
        F.coalesce(F.sum(loss_col), F.lit(0)).cast("double").alias("__loss"))
    base = losses.filter(F.col("model_name") == champion).select(
        period_col, F.col("__loss").alias("__champion"))
    pairs = losses.filter(F.col("model_name") != champion).join(base, period_col).select(
        F.col("model_name").alias("challenger"), period_col,
        (F.col("__champion") - F.col("__loss")).alias("__d"))
    whole = Window.partitionBy("challenger")
    centred = pairs.withColumn("__d0", F.col("__d") - F.avg("__d").over(whole))
    ordered = whole.orderBy(period_col)
    centred = centred.withColumns({
        f"__d{k}": F.lag("__d0", k).over(ordered) for k in range(1, lags + 1)})
    total = F.sum(F.col("__d0") * F.col("__d0"))
    for k in range(1, lags + 1):
        weight = 2.0 * (1.0 - k / (lags + 1.0))
        total = total + F.lit(weight) * F.coalesce(
            F.sum(F.col("__d0") * F.col(f"__d{k}")), F.lit(0.0))
    n = F.count(F.lit(1))
    # Rounding must not pass for variance.
    least = F.lit(1e-18) * F.sum(F.col("__d") * F.col("__d"))
    found = centred.groupBy("challenger").agg(
        n.alias("n_periods"), F.avg("__d").alias("mean_difference"),
        F.when(total > least, total / (n * n)).otherwise(0.0).alias("variance"))
    statistic = F.try_divide(F.col("mean_difference"), F.sqrt("variance"))
    sure = F.abs("statistic") > z_value(confidence)
    better = F.col("mean_difference") > 0
    return found.withColumn("statistic", statistic).select(
        F.lit(champion).alias("champion"), "challenger", "n_periods", "mean_difference",
        F.sqrt("variance").alias("standard_error"), "statistic",
        F.when(F.coalesce(sure, F.col("mean_difference") != 0) & better, "challenger").when(
            F.coalesce(sure, F.lit(True)), "champion").otherwise("undecided").alias("decision"))
