"""Regression on covariates ahead of the ARIMA step.

Slopes come from sums over a (series, fold): Spark adds up the moments, and only the
small per-group linear systems are solved in numpy, a batch of groups at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from foldcast.functions import kernels
from foldcast.operators.arima import TINY, use_regressor


def remove_one(grid: DataFrame, covariate: str, series_col: str = "series") -> DataFrame:
    """Take one covariate's linear effect out, with its least-squares slope."""
    whole = Window.partitionBy(series_col, "fold")
    x = F.when(F.col("y").isNotNull(), F.col(covariate).cast("double"))
    var = F.var_pop(x).over(whole)
    cov = F.covar_pop(F.col("y"), F.when(x.isNotNull(), x)).over(whole)
    grid = grid.withColumns({"__var": var, "__cov": cov})
    grid = grid.withColumn("__slope", F.when(
        F.col("__var") > TINY, F.col("__cov") / F.col("__var")).otherwise(0.0))
    return use_regressor(grid, {covariate: F.col("__slope")}).drop("__var", "__cov", "__slope")


def moment_sums(columns: Sequence[Column]) -> list[Column]:
    """Count, sums and upper-triangle product sums of columns, as aggregates."""
    sums = [F.count(columns[0]).cast("double")] + [F.sum(c) for c in columns]
    return sums + [F.sum(a * b) for i, a in enumerate(columns) for b in columns[i:]]


def by_fold(models: DataFrame, value_col: str, series_col: str = "series") -> DataFrame:
    """One row per series with a map from fold to value. Joining it back needs only the
    series as key, so rows already partitioned by series stay where they are."""
    return models.groupBy(series_col).agg(
        F.map_from_entries(F.collect_list(F.struct("fold", value_col))).alias(value_col))


def remove_many(grid: DataFrame, covariates: Sequence[str], series_col: str = "series"
                ) -> DataFrame:
    """Take the joint linear effect of several covariates out. Covariates that do not
    vary within a (series, fold) have slope 0."""
    known = F.col("y").isNotNull()
    for c in covariates:
        known = known & F.col(c).isNotNull()
    columns = [F.when(known, F.col(c).cast("double")) for c in [*covariates, "y"]]
    solve = pandas_udf(kernels.regression_slopes, "array<double>")
    slopes = grid.groupBy(series_col, "fold").agg(F.array(*moment_sums(columns)).alias("m")).select(
        series_col, "fold", solve("m").alias("__slopes"))
    joined = grid.join(by_fold(slopes, "__slopes", series_col), series_col)
    joined = joined.withColumn("__slopes", F.col("__slopes")[F.col("fold")])
    return use_regressor(joined, {
        c: F.col("__slopes")[i] for i, c in enumerate(covariates)}).drop("__slopes")
