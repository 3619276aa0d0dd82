"""From events to a regular panel: key, roll up, enrich, fill gaps.

After ``roll_up`` a series has at most one row per calendar period, so every
later window over one series is bounded by the length of the calendar, however
skewed the raw events are. The roll-up itself combines on the map side, so a hot
key arrives at the reducers as one partial row per (task, period).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldcast.functions.columns import as_date, period_days, period_start, series_id


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by key into as many tasks as the session asks for.

    A panel is small in bytes but about to be fanned out over folds and windows.
    Adaptive execution sizes tasks by the bytes before the fan-out and would merge
    them into a few; a fixed number, the session's shuffle partitions, keeps every core busy.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def with_series_id(df: DataFrame, parts: Sequence[str], name: str = "series") -> DataFrame:
    return df.withColumn(name, series_id(*parts))


def roll_up(events: DataFrame, time_col: str, key_cols: Sequence[str], count_col: str,
            attribute_cols: Sequence[str] = (), granularity: str = "WEEKLY",
            period_name: str = "period", target_name: str = "qty",
            start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per (period, key) with the number of non-NULL ``count_col`` values.

    ``start``/``end`` (half-open) are applied to the bare time column, so that
    they reach the scan; both must be period boundaries.
    """
    if start is not None:
        events = events.filter(F.col(time_col) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        events = events.filter(F.col(time_col) < F.lit(end).cast("timestamp_ntz"))
    return (
        events.groupBy(period_start(time_col, granularity).alias(period_name), *key_cols)
        .agg(F.count(count_col).alias(target_name),
             *[F.min(c).alias(c) for c in attribute_cols])
    )


def merge_periods(panel: DataFrame, series_col: str = "series", period_col: str = "period",
                  target_col: str = "qty", attribute_cols: Sequence[str] = ()) -> DataFrame:
    """Combine panel rows that share a series and period, e.g. after several raw
    keys were normalised to the same series id."""
    return panel.groupBy(period_col, series_col).agg(
        F.sum(target_col).alias(target_col),
        *[F.min(c).alias(c) for c in attribute_cols])


def period_spine(bounds: DataFrame, start: str | Column, end: str | Column,
                 granularity: str = "WEEKLY", name: str = "period") -> DataFrame:
    """All periods from ``start`` to ``end``, both included, per row of ``bounds``."""
    step = F.make_dt_interval(F.lit(period_days(granularity)))
    return bounds.select(F.explode(F.sequence(as_date(start), as_date(end), step)).alias(name))


def spine_between(spark: SparkSession, start: str, end: str, granularity: str = "WEEKLY",
                  name: str = "period") -> DataFrame:
    return period_spine(spark.range(1), start, end, granularity, name)


def simulate_covariate(spine: DataFrame, name: str, seed: int,
                       period_col: str = "period") -> DataFrame:
    """A covariate in [0, 1) per period, for trying out covariate models: drawn by a hash
    of seed and date, so that it does not depend on how rows are partitioned."""
    key = F.concat(F.lit(f"{seed}:"), F.date_format(period_col, "yyyy-MM-dd"))
    digits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return spine.withColumn(name, digits / F.lit(float(1 << 32)))


def enrich(panel: DataFrame, calendar: DataFrame, panel_key: str | Column = "period",
           calendar_key: str = "period") -> DataFrame:
    """Left join a calendar on the panel's date; periods it lacks give NULL.

    A calendar holds one row per period, so Catalyst's size check broadcasts it;
    nothing here forces that.
    """
    key = F.col(panel_key) if isinstance(panel_key, str) else panel_key
    right = calendar.withColumnRenamed(calendar_key, "__calendar_key")
    return panel.join(right, key.cast("date") == F.col("__calendar_key"), "left").drop(
        "__calendar_key")


def fill_gaps(panel: DataFrame, series_col: str = "series", period_col: str = "period",
              target_col: str = "qty", granularity: str = "WEEKLY",
              start: str | Column | None = None, end: str | Column | None = None,
              attribute_cols: Sequence[str] = (), gap_value: int | None = 0,
              seen_col: str | None = None, varying_cols: Sequence[str] = ()) -> DataFrame:
    """Put zeros (or ``gap_value``) where a series has no row. ``seen_col`` adds a flag
    that tells the panel's own rows from the filled ones.

    The grid of a series runs from its first period (or ``start`` when given) to
    ``end`` (included; its last period when not given). One window over the series
    does it: each row emits itself and the zeros up to the next row, so there is no
    series-by-dates product to build and join. ``attribute_cols`` must be constant
    within a series; ``varying_cols`` are taken from a series' own rows and are NULL on
    filled ones.
    """
    days = period_days(granularity)
    step = F.make_dt_interval(F.lit(days))
    period = F.col(period_col)
    w = Window.partitionBy(series_col).orderBy(period_col)
    upto = F.lead(F.date_sub(period, days)).over(w)
    upto = F.coalesce(upto, as_date(end) if end is not None else period)
    since = period
    if start is not None:
        first = F.lag(period).over(w).isNull()
        since = F.when(first, F.least(as_date(start), period)).otherwise(period)
        since = F.greatest(since, as_date(start))
    if end is not None:
        upto = F.least(upto, as_date(end))
    return (
        panel.withColumn("__since", since).withColumn("__upto", upto)
        .filter(F.col("__since") <= F.col("__upto"))
        .select(series_col, *attribute_cols, *varying_cols, period.alias("__own"), target_col,
                F.explode(F.sequence("__since", "__upto", step)).alias("__period"))
        .select(series_col, *attribute_cols, F.col("__period").alias(period_col), *(
                    [(F.col("__period") == F.col("__own")).alias(seen_col)] if seen_col else []),
                F.when(F.col("__period") == F.col("__own"), F.col(target_col))
                .otherwise(F.lit(gap_value)).cast(panel.schema[target_col].dataType).alias(target_col),
                *[F.when(F.col("__period") == F.col("__own"), F.col(c)).alias(c)
                  for c in varying_cols])
    )
