"""ARIMA with orders chosen automatically: p + q up to a maximum, d by KPSS.

Two stages (Hannan-Rissanen). Stage one fits a long autoregression by Yule-Walker;
stage two regresses the series on its lags and the lagged stage-one residuals. Spark
lags the rows and adds up product sums; since every candidate order uses a subset of
the same sums, one aggregate per (series, fold) serves them all, and a numpy kernel
compares the candidates for a batch of groups.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from foldcast.functions import kernels
from foldcast.functions.columns import limit, period_days, z_value
from foldcast.operators import adjust
from foldcast.operators.arima import choose_difference, remove_effects
from foldcast.operators.decompose import SEASON
from foldcast.operators.xreg import moment_sums

MODEL_TYPE = ("p int, q int, ar array<double>, ma array<double>, intercept double, "
              "variance double, aic double, mean array<double>, error array<double>")


def _lags(name: str, n: int, w) -> dict[str, Column]:
    return {f"__{name}{i}": F.lag(f"__{name}", i).over(w) for i in range(1, n + 1)}


def _residuals(rows: DataFrame, order: int, keys: list[str], period_col: str) -> DataFrame:
    """Add ``__e``, the residual of each row against the group's own long lags, which
    are fitted by Yule-Walker from the group's autocovariances.

    The coefficients are needed next to the rows they were summed from. A group's rows
    (bounded by the calendar) ride along with its sums in one aggregate and are unfolded
    again beside the solution: no second pass over the rows and no join.
    """
    w = Window.partitionBy(*keys).orderBy(period_col)
    carried = [c for c in rows.columns if c not in keys]
    lagged = rows.withColumns(_lags("v", order, w))
    gammas = F.array(F.sum(F.col("__v") * F.col("__v")), *[
        F.coalesce(F.sum(F.col("__v") * F.col(f"__v{i}")), F.lit(0.0))
        for i in range(1, order + 1)])
    solve = pandas_udf(kernels.yule_walker, "array<double>")
    rows = (
        lagged.groupBy(*keys)
        .agg(gammas.alias("g"), F.collect_list(F.struct(*carried)).alias("rows"))
        .select(*keys, solve("g").alias("__long"), "rows")
        .select(*keys, "__long", F.inline("rows"))
        .withColumns(_lags("v", order, w)))
    fitted = F.lit(0.0)
    for i in range(1, order + 1):
        fitted = fitted + F.col("__long")[i - 1] * F.col(f"__v{i}")
    return rows.withColumn("__e", F.col("__v") - fitted).drop("__long")


def fit(grid: DataFrame, horizon: int, max_order: int = 5, long_order: int = 8,
        series_col: str = "series", period_col: str = "period", season: int = SEASON,
        rows_too: bool = False, adjusted: bool = False) -> DataFrame:
    """One row per (series, fold) with the chosen model, its forecasts for ``horizon``
    periods, and the effects to add back on each of the fold's test dates. ``rows_too``
    keeps the group's rows (bounded by the calendar) beside its model, for ``explain``.
    With ``adjusted``, spikes, dips and step changes are taken out of the history first."""
    if long_order < max_order:
        raise ValueError("the long autoregression must cover the largest order")
    keys = [series_col, "fold"]
    rows = remove_effects(grid, series_col, period_col, season)
    if adjusted:
        rows = adjust.adjust(rows, keys, period_col)
    rows = choose_difference(rows, series_col, period_col)
    parts = ["seasonal", "holiday_effect", "regressor"]
    extra = ["spikes_and_dips", "step_changes"] if adjusted else []
    rows = rows.select(
        *keys, period_col, "t", "time_series_type", "z", "d",
        (F.col("t") - F.col("last_t")).alias("h"),
        F.when(F.col("d") == 1, F.col("z") - F.col("__z1")).otherwise(F.col("z")).alias("__v"),
        "actual", "__z1", *parts, *extra,
        (F.col("seasonal") + F.col("holiday_effect") + F.col("regressor")).alias("__effects"))
    rows = rows.withColumn("__mean", F.avg("__v").over(Window.partitionBy(*keys)))
    rows = rows.withColumn("__v", F.col("__v") - F.col("__mean"))
    rows = _residuals(rows, long_order, keys, period_col)
    rows = rows.withColumns(
        _lags("e", max_order, Window.partitionBy(*keys).orderBy(period_col)))

    # One sample for all candidates: NULL unless every column is known.
    names = [*[f"__v{i}" for i in range(1, max_order + 1)],
             *[f"__e{i}" for i in range(1, max_order + 1)], "__v"]
    known = F.col(names[0]).isNotNull()
    for c in names[1:]:
        known = known & F.col(c).isNotNull()
    rows = rows.withColumns({f"{c}__in": F.when(known, F.col(c)) for c in names})

    last = F.when(F.col("time_series_type") == "history", F.col("t"))
    newest = [f"__{s}{i or ''}" for s in "ve" for i in range(max_order)]
    # Only plain sums and extremes: the whole aggregate stays in generated code.
    lagged = [F.array(*[F.col(f"__{s}{i}") for i in range(1, max_order + 1)]).alias(f"lags_{s}")
              for s in "ve"]
    carried = [F.collect_list(F.struct(
        period_col, "time_series_type", "actual", "h", F.col("__z1").alias("z1"), *parts,
        *extra, *lagged)).alias("rows")] if rows_too else []
    sums = moment_sums([F.col(f"{c}__in") for c in names])
    groups = rows.groupBy(*keys).agg(
        *[c.alias(f"m{i}") for i, c in enumerate(sums)],
        *[F.max_by(F.coalesce(c, F.lit(0.0)), last).alias(f"last{c}") for c in newest],
        *[F.max(F.when(F.col("h") == h, F.col("__effects"))).alias(f"effect{h}")
          for h in range(1, horizon + 1)],
        F.min(F.when(F.col("h") == 1, F.col(period_col))).alias("first_test_period"),
        F.max("d").alias("d"), F.max_by("z", last).alias("last_z"), F.max(last).alias("n"),
        F.max("__mean").alias("mean_v"), *carried)
    choose_arma = kernels.choose_arma

    @pandas_udf(MODEL_TYPE)
    def choose(m: pd.Series, newest: pd.Series, z: pd.Series, mean: pd.Series, d: pd.Series
               ) -> pd.DataFrame:
        return choose_arma(m, newest, z, mean, d, max_order, horizon)

    model = choose(F.array(*[f"m{i}" for i in range(len(sums))]),
                   F.array(*[f"last{c}" for c in newest]), "last_z", "mean_v", "d")
    return groups.select(
        *keys, "n", "d", "first_test_period",
        F.array(*[f"effect{h}" for h in range(1, horizon + 1)]).alias("effects"),
        model.alias("model"), "mean_v", *(["rows"] if rows_too else [])
    ).select("*", "model.*").drop("model")


def forecast(models: DataFrame, confidence: float = 0.9, lower: float | None = None,
             upper: float | None = None, granularity: str = "WEEKLY",
             series_col: str = "series", period_col: str = "period") -> DataFrame:
    """Forecast rows with intervals of the given two-sided coverage."""
    days = period_days(granularity)
    rows = models.select("fold", series_col, "first_test_period", F.posexplode(
        F.arrays_zip("mean", "error", "effects")).alias("step", "a"))
    rows = rows.filter(F.col("a.effects").isNotNull())
    value = F.col("a.mean") + F.col("a.effects")
    width = F.lit(z_value(confidence)) * F.col("a.error")
    return rows.select(
        "fold", series_col,
        F.date_add("first_test_period", F.col("step") * days).alias(period_col),
        F.lit("forecast").alias("time_series_type"), F.col("a.error").alias("standard_error"),
        limit(value, lower, upper).alias("forecast_value"),
        limit(value - width, lower, upper).alias("prediction_interval_lower_bound"),
        limit(value + width, lower, upper).alias("prediction_interval_upper_bound"))


def explain(grid: DataFrame, horizon: int, max_order: int = 5, long_order: int = 8,
            confidence: float = 0.95, granularity: str = "WEEKLY", series_col: str = "series",
            period_col: str = "period", season: int = SEASON, adjusted: bool = False
            ) -> DataFrame:
    """History and forecast rows with their components, in the columns of
    ``arima.explain``, those of an adjusted history too. On history rows ``forecast_value`` is the one-step-ahead fit (NULL
    until all its lags are there); on forecast rows it carries an interval."""
    models = fit(grid, horizon, max_order, long_order, series_col, period_col, season, True,
                 adjusted)
    rows = models.select("fold", series_col, "d", "ar", "ma", "intercept", "mean_v", "mean",
                         "error", F.inline("rows"))

    def weighted(coefficients: str, lags: str, shift: Column) -> Column:
        terms = F.zip_with(coefficients, F.slice(F.col(lags), F.lit(1), F.size(coefficients)),
                           lambda a, x: a * (x + shift))
        return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)

    ahead = F.col("time_series_type") == "forecast"
    step = F.col("intercept") + weighted("ar", "lags_v", F.col("mean_v")) + weighted(
        "ma", "lags_e", F.lit(0.0))
    past = step + F.when(F.col("d") == 1, F.col("z1")).otherwise(F.lit(0.0))
    rows = rows.withColumns({
        "trend": F.when(ahead, F.get("mean", F.col("h") - 1)).otherwise(past),
        "standard_error": F.when(ahead, F.get("error", F.col("h") - 1))})
    rows = rows.withColumn("forecast_value", F.col("trend") + F.col("seasonal")
                           + F.col("holiday_effect") + F.col("regressor"))
    width = F.lit(z_value(confidence)) * F.col("standard_error")
    return rows.select(
        "fold", series_col, period_col, "time_series_type",
        F.when(ahead, F.col("forecast_value")).otherwise(F.col("actual")).alias(
            "time_series_data"),
        "forecast_value", "standard_error", F.lit(confidence).alias("confidence_level"),
        (F.col("forecast_value") - width).alias("prediction_interval_lower_bound"),
        (F.col("forecast_value") + width).alias("prediction_interval_upper_bound"),
        "trend", "seasonal", "holiday_effect", F.col("regressor").alias("regressor_effect"),
        *adjust.columns(rows, ahead))


def training_info(models: DataFrame) -> DataFrame:
    """Per fold: how many series and rows were fitted, how well, and how many series each
    order was chosen for, as a map from "p,d,q"."""
    order = F.concat_ws(",", *[F.col(c).cast("string") for c in "pdq"])
    each = models.groupBy("fold", order.alias("order")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n").alias("rows"),
        F.sum(F.col("variance") * F.col("n")).alias("sse"), F.sum("aic").alias("aic"))
    return each.groupBy("fold").agg(
        F.sum("n").alias("n_series"), F.sum("rows").alias("n_rows"), F.sum("sse").alias("sse"),
        (F.sum("aic") / F.sum("n")).alias("mean_aic"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("order", "n")))).alias("orders"))


def coefficients(models: DataFrame, series_col: str = "series") -> DataFrame:
    return models.select(
        "fold", series_col, "p", "d", "q", F.col("ar").alias("ar_coefficients"),
        F.col("ma").alias("ma_coefficients"), F.col("intercept").alias("intercept_or_drift"),
        "variance", "aic", F.col("n").alias("n_rows"))
