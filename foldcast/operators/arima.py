"""Per-series ARIMA forecasts for all folds in one plan.

A series is brought onto a regular grid, fanned out over the folds whose test range it
can reach, and split into seasonal, holiday and regressor effects; the rest follows one
of (0,0,0)+mean, (1,0,0), (0,1,0)+drift, (1,1,0). The difference order comes from a
KPSS level test, the autoregressive order from AIC. Every estimate is a ratio of sums
over one (series, fold), so fitting and forecasting are window aggregates over a single
shuffle by series: nothing is collected, and no model table is joined back.

A (series, fold) group is bounded by the calendar: one row per period.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.columns import limit, period_days, z_value
from foldcast.operators import adjust
from foldcast.operators.decompose import SEASON, centred_trend
from foldcast.operators.folds import Rolling, fan_out
from foldcast.operators.panel import enrich, fill_gaps, spread

# 5 % point of the KPSS level statistic, bounds of the estimates.
KPSS_CRITICAL = 0.463
MAX_AR = 0.98
MIN_SAMPLE = 8
TINY = 1e-9
LEAST_VARIANCE = 1e-12


def fold_grid(panel: DataFrame, rolling: Rolling, calendar: DataFrame | None = None,
              covariates: Sequence[str] = (), holidays: DataFrame | None = None,
              series_col: str = "series", period_col: str = "period",
              target_col: str = "qty", granularity: str = "WEEKLY", fill: str = "zero",
              season: int = SEASON, attributes: Sequence[str] = (),
              origin: str = "test_start", series_covariates: Sequence[str] = ()) -> DataFrame:
    """Training and test rows of every (series, fold).

    Columns: series, ``fold``, period, ``test_start_date``, ``y`` (NULL on test rows),
    ``actual``, ``holiday``, the calendar's covariates, the panel's ``attributes`` (constant
    within a series), its ``series_covariates`` (of each series and period, test rows too; a
    filled row takes the last value before it, else 0), and the centred trends of all of them. Missing training periods are 0 or, with ``fill="none"``, stay NULL.
    A series without training rows in a fold gets no rows there: it is a cold start and
    has no forecast.

    Forecasts start at the fold's test start. With ``origin="series_end"`` they start after
    the series' own last training row and reach one horizon from there, so that a series
    that went silent may not reach the test range.

    Trends are taken before the fan-out. A centred average does not depend on the fold
    as long as its span ends before the test start; where it does not, it is NULL.
    """
    if fill not in ("zero", "none"):
        raise ValueError(f"unsupported fill: {fill}")
    if origin not in ("test_start", "series_end"):
        raise ValueError(f"unsupported forecast origin: {origin}")
    days = period_days(granularity)
    base = spread(panel.select(series_col, period_col, target_col, *attributes, *series_covariates),
                  series_col)
    grid = fill_gaps(base, series_col, period_col, target_col, granularity,
                     end=F.date_sub(rolling.last_day(), 1),
                     attribute_cols=attributes, gap_value=0 if fill == "zero" else None,
                     seen_col="__seen", varying_cols=series_covariates)
    covariates = [*covariates, *attributes, *series_covariates]
    if calendar is not None:
        grid = enrich(grid, calendar, period_col, "period")
    if holidays is not None:
        # Two holidays in one period share an effect, under the first one's name.
        named = holidays.groupBy("period").agg(F.min("holiday").alias("holiday"))
        grid = enrich(grid, named, period_col, "period")
    else:
        grid = grid.withColumn("holiday", F.lit(None).cast("string"))
    # In period order the least period so far is the first one; it shares the trends' window.
    so_far = Window.partitionBy(series_col).orderBy(period_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    grid = grid.withColumns({c: F.coalesce(c, F.last(c, True).over(so_far), F.lit(0))
                             for c in series_covariates})
    grid = grid.withColumns({
        "__first": F.min(period_col).over(so_far),
        **{f"{c}_trend": centred_trend(F.col(c), [series_col], period_col, season)
           for c in [target_col, *covariates]}})
    rows = fan_out(grid, rolling, lambda f: (F.col(period_col) < f["test_end_date"])
                   & (F.col("__first") < f["test_start_date"]))
    start = F.col("f.test_start_date")
    train = F.col(period_col) < start
    # Days from the period to the end of training: positive on training rows.
    left = F.datediff(start, period_col)
    if origin == "series_end":
        last_seen = F.max(F.when(F.col("__seen") & train, F.col(period_col))).over(
            Window.partitionBy(series_col, "f.fold"))
        rows = rows.withColumn("__end", F.date_add(last_seen, days)).filter(
            F.col(period_col) < F.date_add("__end", days * rolling.periods(granularity)))
        train = F.col(period_col) < F.col("__end")
        left = F.datediff("__end", period_col)
    whole_span = left > days * (season // 2)
    kind = F.when(train, "history").otherwise("forecast")
    trends = {"y_trend": target_col, **{f"{c}_trend": c for c in covariates}}
    return rows.select(
        series_col, F.col("f.fold").alias("fold"), period_col,
        start.alias("test_start_date"), kind.alias("time_series_type"),
        ((F.datediff(period_col, "__first") / days).cast("int") + 1).alias("t"),
        F.col(target_col).cast("double").alias("actual"),
        F.when(train, F.col(target_col).cast("double")).alias("y"), "holiday", *covariates,
        *[F.when(whole_span, F.col(f"{c}_trend")).alias(n) for n, c in trends.items()])


def use_regressor(grid: DataFrame, slopes: Mapping[str, Column]) -> DataFrame:
    """Take the covariates' linear part out of the target, given a slope for each. The
    trend of a linear part is the same combination of the covariates' trends."""
    def combined(suffix: str) -> Column:
        total = F.lit(0.0)
        for c, b in slopes.items():
            total = total + b * F.col(f"{c}{suffix}")
        return total

    return grid.withColumns({"regressor": combined(""), "regressor_trend": combined("_trend")})


def remove_effects(grid: DataFrame, series_col: str = "series", period_col: str = "period",
                   season: int = SEASON) -> DataFrame:
    """Split ``y`` less its regressor part into ``seasonal``, ``holiday_effect`` and the
    remainder ``z``. Series shorter than two seasons get no seasonal effect."""
    keys = [series_col, "fold"]
    if "regressor" not in grid.columns:
        grid = use_regressor(grid, {})
    whole = Window.partitionBy(*keys)
    phase = Window.partitionBy(*keys, "__phase")
    u, d = F.col("y") - F.col("regressor"), F.col("__d")
    out = grid.withColumns({
        "__d": u - F.col("y_trend") + F.col("regressor_trend"),
        "__phase": (F.col("t") - 1) % season})
    out = out.withColumns({"__raw": F.avg(d).over(phase), "__in_phase": F.count(d).over(phase)})
    out = out.withColumns({
        "n": F.count("y").over(whole),
        "last_t": F.max(F.when(
            F.col("time_series_type") == "history", F.col("t"))).over(whole),
        "__mean": F.sum(F.try_divide(d, F.col("__in_phase"))).over(whole) / season})
    long_enough = F.col("n") >= 2 * season
    out = out.withColumn("seasonal", F.when(
        long_enough, F.coalesce(F.col("__raw") - F.col("__mean"), F.lit(0.0))).otherwise(0.0))
    effect = F.avg(d - F.col("seasonal")).over(Window.partitionBy(*keys, "holiday"))
    out = out.withColumn("holiday_effect", F.when(
        F.col("holiday").isNotNull(), F.coalesce(effect, F.lit(0.0))).otherwise(0.0))
    return out.withColumn(
        "z", u - F.col("seasonal") - F.col("holiday_effect")
    ).drop("__d", "__phase", "__raw", "__in_phase", "__mean")


def choose_difference(rows: DataFrame, series_col: str = "series",
                      period_col: str = "period") -> DataFrame:
    """Add lags of ``z``, its KPSS level statistic and the difference order ``d``."""
    keys = [series_col, "fold"]
    whole, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(period_col)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    z, e = F.col("z"), F.col("__e")
    out = rows.withColumn("__e", z - F.avg(z).over(whole))
    out = out.withColumns({
        "__s": F.when(z.isNotNull(), F.sum(e).over(running)),
        "__z1": F.lag(z).over(ordered), "__z2": F.lag(z, 2).over(ordered)})
    out = out.withColumns({
        "__ss": F.sum(F.col("__s") * F.col("__s")).over(whole),
        "__vv": F.sum(e * e).over(whole)})
    varies = F.col("__vv") > TINY * F.col("n")
    out = out.withColumn("kpss", F.when(
        varies, F.try_divide(F.col("__ss"), F.col("n") * F.col("__vv"))))
    return out.withColumn(
        "d", F.when(F.col("kpss") > KPSS_CRITICAL, 1).otherwise(0)
    ).drop("__e", "__s", "__ss", "__vv")


def fit(grid: DataFrame, series_col: str = "series", period_col: str = "period",
        season: int = SEASON, adjusted: bool = False) -> DataFrame:
    """Fit every (series, fold) of a ``fold_grid``. The result keeps one row per period
    and carries the group's model on each: ``p``, ``d``, ``phi``, ``intercept``,
    ``sigma2``, ``aic``, ``sse``, last values. With ``adjusted``, spikes, dips and step
    changes are taken out of the history first."""
    rows = remove_effects(grid, series_col, period_col, season)
    if adjusted:
        rows = adjust.adjust(rows, [series_col, "fold"], period_col)
    rows = choose_difference(rows, series_col, period_col)
    whole = Window.partitionBy(series_col, "fold")
    differenced = F.col("d") == 1
    z, z1, z2 = F.col("z"), F.col("__z1"), F.col("__z2")
    y, x = F.col("__y"), F.col("__x")
    rows = rows.withColumns({
        "__level": F.when(differenced, z - z1).otherwise(z),
        "__x": F.when(differenced, z1 - z2).otherwise(z1)})
    # The mean-only and the autoregressive model are compared on the same sample.
    rows = rows.withColumn("__y", F.when(x.isNotNull(), F.col("__level")))
    x = F.when(y.isNotNull(), x)
    rows = rows.withColumns({
        "m": F.count(y).over(whole), "__sy": F.sum(y).over(whole),
        "__sx": F.sum(x).over(whole), "__syy": F.sum(y * y).over(whole),
        "__sxx": F.sum(x * x).over(whole), "__sxy": F.sum(x * y).over(whole),
        "last_z": F.max_by(z, F.when(z.isNotNull(), F.col("t"))).over(whole),
        "last_w": F.max_by(F.col("__level"), F.when(
            F.col("__level").isNotNull(), F.col("t"))).over(whole)})
    m, sx, sy = F.col("m"), F.col("__sx"), F.col("__sy")
    cxx = F.col("__sxx") - F.try_divide(sx * sx, m)
    cxy = F.col("__sxy") - F.try_divide(sx * sy, m)
    cyy = F.greatest(F.col("__syy") - F.try_divide(sy * sy, m), F.lit(0.0))
    rows = rows.withColumns({"__cxx": cxx, "__cxy": cxy, "__cyy": cyy})
    estimate = F.when((m >= MIN_SAMPLE) & (F.col("__cxx") > TINY * m), F.greatest(
        F.least(F.col("__cxy") / F.col("__cxx"), F.lit(MAX_AR)), F.lit(-MAX_AR)))
    rows = rows.withColumn("__ar", estimate)
    ar = F.col("__ar")
    rows = rows.withColumn("__sse1", F.greatest(
        F.col("__cyy") - 2 * ar * F.col("__cxy") + ar * ar * F.col("__cxx"), F.lit(0.0)))

    def aic(sse: Column, parameters: int) -> Column:
        variance = F.greatest(F.try_divide(sse, m), F.lit(LEAST_VARIANCE))
        return F.when(m > 0, m * F.log(variance) + 2 * parameters)

    rows = rows.withColumns({"__aic0": aic(F.col("__cyy"), 1), "__aic1": F.when(
        ar.isNotNull(), aic(F.col("__sse1"), 2))})
    use_ar = F.coalesce(F.col("__aic1") < F.col("__aic0"), F.lit(False))
    rows = rows.withColumns({
        "p": F.when(use_ar, 1).otherwise(0), "phi": F.when(use_ar, ar).otherwise(0.0),
        "sse": F.coalesce(F.when(use_ar, F.col("__sse1")).otherwise(F.col("__cyy")),
                          F.lit(0.0)),
        "aic": F.when(use_ar, F.col("__aic1")).otherwise(F.col("__aic0"))})
    # A single observation is carried forward.
    flat = F.when(differenced, F.lit(0.0)).otherwise(F.col("last_z"))
    rows = rows.withColumns({
        "intercept": F.coalesce(F.try_divide(sy - F.col("phi") * sx, m), flat),
        "sigma2": F.coalesce(F.try_divide(F.col("sse"), m), F.lit(0.0))})
    return rows.drop("__level", "__y", "__x", "__sy", "__sx", "__syy", "__sxx", "__sxy",
                     "__cxx", "__cxy", "__cyy", "__ar", "__sse1", "__aic0", "__aic1")


def explain(fitted: DataFrame, confidence: float = 0.95, series_col: str = "series",
            period_col: str = "period") -> DataFrame:
    """History and forecast rows with their components.

    On history rows ``forecast_value`` is the one-step-ahead fit; on forecast rows it
    carries an interval of the given two-sided coverage. A fit on adjusted history adds
    ``spikes_and_dips``, ``step_changes`` and ``adjusted_data``.
    """
    phi, c, d = F.col("phi"), F.col("intercept"), F.col("d")
    rows = fitted.withColumn("__h", F.greatest(F.col("t") - F.col("last_t"), F.lit(1)))
    h = F.col("__h")
    mu = c / (1 - phi)
    decay = F.pow(phi, h)
    level = mu + decay * (F.col("last_z") - mu)
    walk = F.col("last_z") + h * mu + F.coalesce(F.col("last_w") - mu, F.lit(0.0)) * phi * (
        1 - decay) / (1 - phi)
    square = F.pow(phi, 2 * h)
    level_var = F.col("sigma2") * (1 - square) / (1 - phi * phi)
    walk_var = F.col("sigma2") / ((1 - phi) * (1 - phi)) * (
        h - 2 * phi * (1 - decay) / (1 - phi) + phi * phi * (1 - square) / (1 - phi * phi))
    z1, z2 = F.col("__z1"), F.col("__z2")
    fit_level = c + F.when(F.col("p") == 1, phi * z1).otherwise(F.lit(0.0))
    fit_walk = z1 + c + F.when(F.col("p") == 1, phi * (z1 - z2)).otherwise(F.lit(0.0))
    ahead = F.col("time_series_type") == "forecast"
    rows = rows.withColumns({
        "trend": F.when(ahead, F.when(d == 1, walk).otherwise(level)).otherwise(
            F.when(d == 1, fit_walk).otherwise(fit_level)),
        "standard_error": F.when(ahead, F.sqrt(F.greatest(
            F.when(d == 1, walk_var).otherwise(level_var), F.lit(0.0))))})
    value = (F.col("trend") + F.col("seasonal") + F.col("holiday_effect")
             + F.col("regressor"))
    width = F.lit(z_value(confidence)) * F.col("standard_error")
    rows = rows.withColumn("forecast_value", value)
    return rows.select(
        "fold", series_col, period_col, "time_series_type",
        F.when(ahead, F.col("forecast_value")).otherwise(F.col("actual")).alias(
            "time_series_data"),
        "forecast_value", "standard_error", F.lit(confidence).alias("confidence_level"),
        (F.col("forecast_value") - width).alias("prediction_interval_lower_bound"),
        (F.col("forecast_value") + width).alias("prediction_interval_upper_bound"),
        "trend", "seasonal", "holiday_effect", F.col("regressor").alias("regressor_effect"),
        *adjust.columns(rows, ahead))


def forecast(fitted: DataFrame, confidence: float = 0.9, lower: float | None = None,
             upper: float | None = None, series_col: str = "series",
             period_col: str = "period") -> DataFrame:
    """Forecast rows only. With a limit, values and bounds are kept inside it."""
    rows = explain(fitted, confidence, series_col, period_col).filter(
        F.col("time_series_type") == "forecast")
    names = ["forecast_value", "prediction_interval_lower_bound",
             "prediction_interval_upper_bound"]
    return rows.select("fold", series_col, period_col, "time_series_type", *[
        limit(F.col(n), lower, upper).alias(n) for n in names])


def with_interval(rows: DataFrame, confidence: float, lower: float | None = None,
                  upper: float | None = None) -> DataFrame:
    """Give stored forecasts the interval of another coverage from their standard error,
    so that one forecast serves every report."""
    width = F.lit(z_value(confidence)) * F.col("standard_error")
    return rows.withColumns({
        "prediction_interval_lower_bound": limit(F.col("forecast_value") - width, lower, upper),
        "prediction_interval_upper_bound": limit(F.col("forecast_value") + width, lower, upper),
    }).withColumn("forecast_value", limit(F.col("forecast_value"), lower, upper))


def coefficients(fitted: DataFrame, series_col: str = "series") -> DataFrame:
    """One row per (fold, series): orders, coefficients, variance and AIC."""
    return (
        fitted.filter(F.col("t") == F.col("last_t"))
        .select("fold", series_col, "p", "d", F.lit(0).alias("q"),
                F.when(F.col("p") == 1, F.array("phi")).otherwise(
                    F.array().cast("array<double>")).alias("ar_coefficients"),
                F.array().cast("array<double>").alias("ma_coefficients"),
                F.col("intercept").alias("intercept_or_drift"),
                F.col("sigma2").alias("variance"), "sse", "aic", "kpss",
                F.col("n").alias("n_rows")))


def training_info(models: DataFrame) -> DataFrame:
    """Per fold: how many series and rows were fitted, how well, and which orders
    were chosen."""
    def chosen(p: int, d: int) -> Column:
        return F.count_if((F.col("p") == p) & (F.col("d") == d)).alias(f"n_order_{p}_{d}_0")

    return models.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_series"), F.sum("n_rows").alias("n_rows"),
        F.sum("sse").alias("sse"), F.avg("aic").alias("mean_aic"),
        *[chosen(p, d) for d in (0, 1) for p in (0, 1)])
