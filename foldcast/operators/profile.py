"""Descriptive statistics of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcast.functions.columns import history_bucket, history_bucket_rank


def count_series(panel: DataFrame, series_col: str = "series") -> DataFrame:
    return panel.agg(F.count_distinct(series_col).alias("n_series"))


def date_range(panel: DataFrame, period_col: str = "period") -> DataFrame:
    return panel.agg(F.min(period_col).alias("start_date"), F.max(period_col).alias("end_date"))


def history_days(panel: DataFrame, series_col: str = "series",
                 period_col: str = "period") -> DataFrame:
    return panel.groupBy(series_col).agg(
        F.datediff(F.max(period_col), F.min(period_col)).alias("history_days"))


def history_buckets(panel: DataFrame, series_col: str = "series",
                    period_col: str = "period") -> DataFrame:
    """Number and share of series per length of history, longest first."""
    counts = (
        history_days(panel, series_col, period_col)
        .groupBy(history_bucket("history_days").alias("history_category"),
                 history_bucket_rank("history_days").alias("bucket_rank"))
        .agg(F.count(series_col).alias("number_of_time_series")))
    # At most five rows are left here, so one partition is enough for the total.
    total = F.sum("number_of_time_series").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn(
        "percentage", F.col("number_of_time_series") * F.lit(100.0) / total
    ).orderBy("bucket_rank")


def missing_values(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per column, all columns in one pass."""
    counts = panel.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "value_count")


def total_demand(panel: DataFrame, period_col: str = "period",
                 target_col: str = "qty") -> DataFrame:
    return panel.groupBy(period_col).agg(F.sum(target_col).alias(target_col))


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column, (input, median), without bringing a column
    into one task.

    ``percentile_approx`` has a guaranteed rank error, so its values a little below
    and above one half bracket the median. Values outside the bracket only matter
    by their number; the second pass counts them on the map side and ranks just the
    few distinct values inside.
    """
    accuracy = 100_000
    margin = 2.0 / accuracy
    value = {c: F.col(c).cast("double") for c in columns}
    brackets = df.agg(F.array(*[
        F.struct(F.lit(c).alias("input"), F.percentile_approx(
            v, [0.5 - margin, 0.5 + margin], accuracy).alias("b"))
        for c, v in value.items()]).alias("s")).select(F.inline("s"))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("input"), v.alias("value")) for c, v in value.items()]))
    ).filter(F.col("value").isNotNull())
    clipped = (
        F.when(F.col("value") < F.col("b")[0], F.lit(float("-inf")))
        .when(F.col("value") > F.col("b")[1], F.lit(float("inf")))
        .otherwise(F.col("value")))
    # One bracket row per input column: broadcast is bounded by the column list.
    counts = (long.join(F.broadcast(brackets), "input")
              .groupBy("input", clipped.alias("value")).agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("input")
    ranked = (counts.withColumn("upto", F.sum("n").over(w.orderBy("value")))
              .withColumn("total", F.sum("n").over(w)))
    def at_rank(rank):
        return F.min(F.when(F.col("upto") >= rank, F.col("value")))

    total = F.col("total")
    low, high = at_rank(F.floor((total + 1) / 2)), at_rank(F.floor(total / 2) + 1)
    return ranked.groupBy("input").agg(((low + high) / 2).alias("median"))


def feature_info(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per input column: min, max, mean, median, standard deviation for numbers,
    number of categories for text, and NULL count."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    none, stats = F.lit(None).cast("double"), []
    for name in columns:
        col = F.col(name)
        if name in numeric:
            value = col.cast("double")
            entry = [F.min(value), F.max(value), F.avg(value), F.stddev(value),
                     F.lit(None).cast("bigint")]
        else:
            entry = [none, none, none, none, F.count_distinct(col)]
        names = ["min", "max", "mean", "stddev", "category_count"]
        stats.append(F.struct(
            F.lit(name).alias("input"), *[e.alias(n) for e, n in zip(entry, names)],
            F.count_if(col.isNull()).alias("null_count")))
    info = df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))
    if not numeric:
        return info.withColumn("median", none)
    return info.join(exact_medians(df, numeric), "input", "left")
