"""The grid of (fold, series, period) that forecasts are compared on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.functions.columns import on_or_after_monday, period_days
from foldcast.operators.folds import Rolling, _array


def test_dates(folds: Rolling | Column, granularity: str = "WEEKLY",
               align: bool = True, end_inclusive: bool = True) -> Column:
    """All test dates of all folds as ``array<struct<fold, test_start_date,
    test_end_date, period>>``.

    ``end_inclusive`` adds the test end date itself. ``align`` moves a weekly start
    up to the panel's Monday grid; without it dates count from the start itself.
    """
    days = period_days(granularity)
    step = F.make_dt_interval(F.lit(days))

    def dates(f: Column) -> Column:
        start = f["test_start_date"]
        if align and days == 7:
            start = on_or_after_monday(start)
        end = f["test_end_date"] if end_inclusive else F.date_sub(f["test_end_date"], 1)
        return F.transform(F.sequence(start, end, step), lambda d: F.struct(
            f["fold"].alias("fold"), f["test_start_date"].alias("test_start_date"),
            f["test_end_date"].alias("test_end_date"), d.alias("period")))

    return F.flatten(F.transform(_array(folds), dates))


def date_scaffold(panel: DataFrame, folds: Rolling | Column, series_col: str = "series",
                  period_col: str = "period", granularity: str = "WEEKLY",
                  align: bool = True, end_inclusive: bool = True) -> DataFrame:
    """Every series of the panel on every test date of every fold.

    The dates come out of each distinct series by ``explode``; there is no
    series-by-dates join.
    """
    array = test_dates(folds, granularity, align, end_inclusive)
    grid = panel.select(series_col).distinct().select(series_col, F.inline(array))
    return grid if period_col == "period" else grid.withColumnRenamed("period", period_col)


def scaffold_actuals(panel: DataFrame, folds: Rolling | Column, series_col: str = "series",
                     period_col: str = "period", target_col: str = "qty",
                     granularity: str = "WEEKLY", align: bool = True,
                     end_inclusive: bool = True) -> DataFrame:
    """The scaffold with actuals; 0 where the panel has no row. Only rows in the
    half-open test range count, so an included end date always has 0. The target keeps
    its type."""
    grid = date_scaffold(panel, folds, series_col, period_col, granularity, align,
                         end_inclusive)
    actual = panel.select(series_col, period_col, target_col)
    in_range = F.col(period_col) < F.col("test_end_date")
    return (
        grid.join(actual, [series_col, period_col], "left")
        .withColumn(target_col, F.when(in_range, F.coalesce(target_col, F.lit(0)))
                    .otherwise(F.lit(0)).cast(panel.schema[target_col].dataType))
        .select("fold", series_col, period_col, "test_start_date", target_col))
