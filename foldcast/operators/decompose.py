"""Classical seasonal decomposition, one series key at a time in parallel.

Periods must be regular (use ``fill_gaps`` first). A series is bounded by the
calendar, so its window never grows with the number of raw events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.columns import replace_zero

SEASON = 52


def centred_trend(value: Column, keys: list[str], order: str, season: int = SEASON) -> Column:
    """Centred moving average over one season (an even one with half weight on both ends);
    NULL where the full span is not there or holds a NaN.

    Frame sums are differences of one running sum, so the cost per row does not
    depend on the length of the season.
    """
    half = season // 2
    value = F.when(~F.isnan(value), value)
    w = Window.partitionBy(*keys).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto, known = F.sum(value).over(run), F.count(value).over(run)
    # Running totals at t+half, t+half-1, t-half and t-half-1 give the span and its inside.
    zero = F.lit(0)
    last, inner_last = F.lead(upto, half).over(w), F.lead(upto, half - 1).over(w)
    first = F.lag(upto, half).over(w)
    before = F.coalesce(F.lag(upto, half + 1).over(w), zero)
    seen = F.lead(known, half).over(w) - F.coalesce(F.lag(known, half + 1).over(w), zero)
    inner, span = inner_last - first, last - before
    if season % 2:
        return F.when(first.isNotNull() & (seen == season), span / F.lit(float(season)))
    return F.when(first.isNotNull() & (seen == season + 1),
                  (inner + span) / F.lit(2.0 * season))


def seasonal_decompose(df: DataFrame, series_col: str = "series", period_col: str = "period",
                       target_col: str = "qty", season: int = SEASON,
                       model: str = "multiplicative", zero_by: float | None = None
                       ) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``resid`` to a regular panel.

    ``multiplicative``: y = trend * seasonal * resid with seasonal factors of mean 1;
    ``additive``: y = trend + seasonal + resid with effects of mean 0. ``zero_by``
    replaces zero targets, which a multiplicative model cannot express.
    """
    if model not in ("multiplicative", "additive"):
        raise ValueError(f"unsupported decomposition: {model}")
    multiply = model == "multiplicative"
    y = F.col(target_col)
    if zero_by is not None:
        df = df.withColumn(target_col, replace_zero(y, zero_by))
    ordered = Window.partitionBy(series_col).orderBy(period_col)
    step1 = df.withColumns({
        "trend": centred_trend(y, [series_col], period_col, season),
        "__phase": (F.row_number().over(ordered) - 1) % season,
    })
    trend, raw = F.col("trend"), F.col("__raw")
    detrended = F.try_divide(y.cast("double"), trend) if multiply else y - trend
    by_phase = Window.partitionBy(series_col, "__phase")
    step2 = step1.withColumn("__detrended", detrended).withColumns({
        "__raw": F.avg("__detrended").over(by_phase),
        "__in_phase": F.count(F.lit(1)).over(by_phase)})
    # Each phase counts once in the mean, however many rows it has.
    whole = Window.partitionBy(series_col)
    mean = (F.sum(raw / F.col("__in_phase")).over(whole)
            / F.sum(F.when(raw.isNotNull(), 1 / F.col("__in_phase"))).over(whole))
    seasonal = F.col("seasonal")
    return (
        step2.withColumn("seasonal", F.try_divide(raw, mean) if multiply else raw - mean)
        .withColumn("resid", F.try_divide(F.try_divide(y.cast("double"), trend), seasonal)
                    if multiply else y - trend - seasonal)
        .drop("__phase", "__detrended", "__raw", "__in_phase"))


def typical_seasonality(decomposed: DataFrame, series_col: str = "series",
                        period_col: str = "period") -> DataFrame:
    """Mean seasonal component per ISO week of the year."""
    return decomposed.groupBy(
        series_col, F.weekofyear(period_col).alias("week_of_year")
    ).agg(F.avg("seasonal").alias("seasonal"))
