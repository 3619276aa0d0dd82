"""Spikes, dips and step changes of a history, taken out before a model is fitted.

Both work on the remainder ``z`` of ``arima.remove_effects``, group by group; a group is
bounded by the calendar. Spikes and dips are far from the median around them, measured by
the group's own median deviation. Step changes are the exact optimum of a penalised
change-point search over the cleaned remainder.
"""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from foldcast.functions import kernels

# Rows on each side whose median is the level that a row is held against.
NEIGHBOURS = 4
# Deviations, in robust standard deviations, from which on a row is a spike or a dip.
SPIKE_WIDTH = 5.0
# A normal standard deviation over its median and its mean absolute deviation.
MEDIAN_TO_SIGMA, MEAN_TO_SIGMA = 1.4826, 1.2533
# Deviations this small are rounding.
ROUNDING = 1e-6
# Periods between two step changes at least; cost of one, in long-run variances x log(n).
LEAST_SEGMENT = 8
STEP_PENALTY = 3.0

COLUMNS = ("spikes_and_dips", "step_changes", "adjusted_data")


def spikes_and_dips(rows: DataFrame, keys: Sequence[str], order: str, value: str = "z",
                    neighbours: int = NEIGHBOURS, width: float = SPIKE_WIDTH) -> DataFrame:
    """Add ``spikes_and_dips``: what a spike (above) or a dip (below) adds to the median of
    the rows around it, 0 on all other rows, NULL where the value is unknown."""
    ordered, whole = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys)
    off = F.col("__off")
    # Sorting a short array is far cheaper than a percentile over a sliding frame.
    near = [F.lag(value, k).over(ordered) for k in range(-neighbours, neighbours + 1)]
    rows = rows.withColumn("__near", F.sort_array(F.array(*near)))  # unknown ones come first
    size = F.lit(2 * neighbours + 1)
    known = F.size(F.array_compact("__near"))
    low, high = size - known + F.floor((known - 1) / 2), size - known + F.floor(known / 2)
    middle = (F.get("__near", low.cast("int")) + F.get("__near", high.cast("int"))) / 2
    rows = rows.withColumn("__off", F.col(value) - middle).drop("__near")
    rows = rows.withColumns({
        "__middle": F.percentile(F.abs(off), 0.5).over(whole),
        "__mean": F.avg(F.abs(off)).over(whole)})
    # Where more than half of the deviations are 0, their mean takes over.
    scale = F.when(F.col("__middle") > ROUNDING, MEDIAN_TO_SIGMA * F.col("__middle")).otherwise(
        MEAN_TO_SIGMA * F.col("__mean"))
    far = F.abs(off) > F.greatest(width * scale, F.lit(ROUNDING))
    return rows.withColumn("spikes_and_dips", F.when(far, off).otherwise(
        F.when(off.isNotNull(), 0.0))).drop("__off", "__middle", "__mean")


def step_changes(rows: DataFrame, keys: Sequence[str], value: Column, order: str = "t",
                 least_segment: int = LEAST_SEGMENT, penalty: float = STEP_PENALTY) -> DataFrame:
    """Add ``step_changes``: the level of the row's segment less that of the last one, so
    that history less its step changes stands at the newest level. Rows without a value
    (forecast rows) have 0.

    A group's rows ride along with the array that is searched; nothing is joined back.
    """
    carried = [c for c in rows.columns if c not in keys]
    step_levels = kernels.step_levels

    @pandas_udf("array<double>")
    def levels(values: pd.Series) -> pd.Series:
        return step_levels(values, least_segment, penalty)

    ordered = rows.withColumn("__value", value).groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct(F.col(order).alias("__at"), "__value", F.struct(*carried).alias("row")))).alias("rows"))
    found = ordered.select(*keys, "rows", levels(F.col("rows.__value")).alias("levels"))
    each = found.select(*keys, F.explode(F.arrays_zip("rows", "levels")).alias("x"))
    return each.select(*keys, "x.rows.row.*", F.coalesce("x.levels", F.lit(0.0)).alias("step_changes"))


def adjust(rows: DataFrame, keys: Sequence[str], period_col: str = "period") -> DataFrame:
    """Take spikes, dips and step changes out of ``z``; both stay as columns."""
    rows = spikes_and_dips(rows, keys, period_col)
    rows = rows.withColumn("z", F.col("z") - F.col("spikes_and_dips"))
    rows = step_changes(rows, keys, F.col("z"))
    return rows.withColumn("z", F.col("z") - F.col("step_changes"))


def columns(rows: DataFrame, ahead: Column) -> list[Column]:
    """The three explanation columns of rows that went through ``adjust``, else none. The
    adjusted data of a forecast row is its forecast."""
    if "spikes_and_dips" not in rows.columns:
        return []
    spikes = F.coalesce("spikes_and_dips", F.lit(0.0))
    steps = F.coalesce("step_changes", F.lit(0.0))
    return [spikes.alias("spikes_and_dips"), steps.alias("step_changes"),
            F.when(ahead, F.col("forecast_value")).otherwise(
                F.col("actual") - spikes - steps).alias("adjusted_data")]
