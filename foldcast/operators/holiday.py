"""Holiday calendar and the effect of holidays on demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.functions import holidays
from foldcast.functions.columns import as_date, period_start


def holiday_calendar(bounds: DataFrame, start: str | Column, end: str | Column,
                     regions: list[str] | None = None, granularity: str = "WEEKLY"
                     ) -> DataFrame:
    """Holidays between two dates (included) with the period each one falls in."""
    start, end = as_date(start), as_date(end)
    years = F.explode(F.sequence(F.year(start), F.year(end)))
    listed = bounds.select(start.alias("s"), end.alias("e"), years.alias("year")).select(
        "s", "e", F.inline(holidays.in_year(F.col("year"), regions or holidays.REGIONS)))
    return listed.filter(F.col("day").between(F.col("s"), F.col("e"))).select(
        "holiday", "region", "day", period_start("day", granularity).alias("period"))


def holiday_effects(decomposed: DataFrame, calendar: DataFrame, series_col: str = "series",
                    period_col: str = "period", target_col: str = "qty") -> DataFrame:
    """Per series and holiday: how demand in the holiday's period compares with its
    trend. The calendar has a few rows per year, so Catalyst's size check broadcasts
    it; each panel row meets at most the holidays of its own period."""
    days = calendar.select(F.col("period").alias(period_col), "holiday").distinct()
    ratio = F.try_divide(F.col(target_col).cast("double"), F.col("trend"))
    return (
        decomposed.join(days, period_col)
        .groupBy(series_col, "holiday")
        .agg(F.avg(ratio).alias("holiday_effect"), F.count(ratio).alias("n_periods")))
