"""LOWESS smoothing of short profiles.

A profile has at most one point per season position (53 ISO weeks), so it fits in
one array value. Each round of the smoother is then an array expression on that row:
the whole smoother, robust rounds included, costs one shuffle, and no pairs of points
are ever emitted as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rounding guard of the neighbourhood size, scale of the residuals.
NEIGHBOUR_GUARD = 1e-10
RESIDUAL_SCALE = 6.0


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _local_fit(x: Column, points: Column, robust: Column, k: Column) -> Column:
    """Value at ``x`` of the weighted line through the k nearest points; NULL when no
    point has any weight."""
    reach = F.element_at(F.array_sort(F.transform(points, lambda p: F.abs(p["x"] - x))), k)

    def weights(radius: Column) -> Column:
        def weigh(p: Column, r: Column) -> Column:
            d = F.abs(p["x"] - x)
            w = F.when(d < radius, F.pow(1 - F.pow(d / radius, 3), 3) * r).otherwise(0.0)
            return F.struct(w.alias("w"), p["x"].alias("x"), p["y"].alias("y"))

        return F.zip_with(points, robust, weigh)

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("w", "x", "y", "xx", "xy")])

    # Moments around x itself keep the sums small.
    def add(acc: Column, q: Column) -> Column:
        dx = q["x"] - x
        return F.struct(
            (acc["w"] + q["w"]).alias("w"), (acc["x"] + q["w"] * dx).alias("x"),
            (acc["y"] + q["w"] * q["y"]).alias("y"),
            (acc["xx"] + q["w"] * dx * dx).alias("xx"),
            (acc["xy"] + q["w"] * dx * q["y"]).alias("xy"))

    def line(m: Column) -> Column:
        mx, my = F.try_divide(m["x"], m["w"]), F.try_divide(m["y"], m["w"])
        sxx = F.greatest(F.try_divide(m["xx"], m["w"]) - mx * mx, F.lit(1e-12))
        sxy = F.try_divide(m["xy"], m["w"]) - mx * my
        return my - mx * sxy / sxx

    return _let(F.aggregate(_let(reach, weights), zero, add), line)


def _fit(points: Column, robust: Column, k: Column) -> Column:
    """One smoothed value per point, given one robustness weight per point."""
    return _let(robust, lambda r: F.transform(
        points, lambda p: F.coalesce(_local_fit(p["x"], points, r, k), p["y"])))


def _median(values: Column) -> Column:
    n = F.size(values)
    return _let(F.array_sort(values), lambda s: (
        F.element_at(s, F.floor((n + 1) / 2).cast("int"))
        + F.element_at(s, F.floor(n / 2).cast("int") + 1)) / 2)


def _robustness(points: Column, fit: Column) -> Column:
    """Bisquare weight of each point's residual."""
    def weigh(residuals: Column, mid: Column) -> Column:
        def bisquare(r: Column) -> Column:
            u = F.when(mid == 0, F.when(r > 0, 1.0).otherwise(0.0)).otherwise(
                F.least(F.try_divide(r, F.lit(RESIDUAL_SCALE) * mid), F.lit(1.0)))
            return F.pow(1 - u * u, 2)

        return F.transform(residuals, bisquare)

    residuals = F.zip_with(points, fit, lambda p, f: F.abs(p["y"] - f))
    return _let(residuals, lambda r: _let(_median(r), lambda m: weigh(r, m)))


def lowess(profile: DataFrame, series_col: str = "series", x_col: str = "week_of_year",
           y_col: str = "seasonal", frac: float = 0.4, iters: int = 3) -> DataFrame:
    """Smooth each series' profile with locally weighted lines over the nearest
    ``frac`` of its points, followed by ``iters`` rounds with bisquare weights on the
    residuals. Returns one row per point with ``smoothed``."""
    point = F.struct(F.col(x_col).cast("double").alias("x"), F.col(y_col).alias("y"))
    rows = profile.groupBy(series_col).agg(
        F.array_sort(F.collect_list(point)).alias("points"))
    points = F.col("points")
    k = F.greatest(F.floor(F.lit(frac) * F.size(points) + F.lit(NEIGHBOUR_GUARD)),
                   F.lit(1)).cast("int")
    fit = _fit(points, F.transform(points, lambda p: F.lit(1.0)), k)
    for _ in range(iters):
        fit = _fit(points, _robustness(points, fit), k)
    smoothed = F.arrays_zip(points, fit.alias("fit"))
    return rows.select(series_col, F.inline(smoothed)).select(
        series_col, F.col("points.x").cast(profile.schema[x_col].dataType).alias(x_col),
        F.col("points.y").alias(y_col), F.col("fit").alias("smoothed"))
