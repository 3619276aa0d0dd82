"""Pooled direct linear models, one head per step ahead, for all folds in one pass.

A head is solved from sums of products of its inputs and its target. A training example
belongs to every fold that starts after its target, so sums are taken per head and per
stretch between two test starts; what a fold learns from is their running total. A robust
fit weighs examples by their residuals and sums again: one pass per iteration, for all
folds and heads together. Tasks hold a matrix per head and fold, never examples.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.functions import kernels
from foldcast.operators.folds import Rolling
from foldcast.sources.scratch import cut_lineage

# Huber's bound in standard deviations, and the share of a normal variance
# that errors cut at it keep.
HUBER_BOUND, HUBER_SHARE = 1.345, 0.7101645
# A fit has converged when no input's part in the forecast moves by more than this share
# of the target's spread; this many iterations end one that does not.
TOLERANCE, MAX_ITERATIONS = 1e-3, 25

MODEL = ("fold int, h int, intercept double, slopes array<double>, sigma double, "
         "n_rows bigint, change double")
MODEL_SCHEMA = pa.schema({"fold": pa.int32(), "h": pa.int32(), "intercept": pa.float64(),
                          "slopes": pa.list_(pa.float64()), "sigma": pa.float64(),
                          "n_rows": pa.int64(), "change": pa.float64()})


def numbered(examples: DataFrame, inputs: Sequence[str], rolling: Rolling,
             period_col: str = "period") -> DataFrame:
    """Examples as ``x`` (the inputs, unknown ones 0) and ``target``, with ``since``: the
    number of folds that start no later than the target, hence the first to learn from it."""
    starts = F.transform(rolling.array(), lambda f: f["test_start_date"])
    since = F.size(F.filter(starts, lambda s: s <= F.col(period_col)))
    return examples.select(
        "*", since.alias("since"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs]).alias("x"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows of 1, inputs, target."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    y = batch.column("target").to_numpy(zero_copy_only=False)
    return np.hstack([np.ones((len(x), 1)), x, y[:, None]])


def _emit(sums: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (h, part), values in sums.items():
        n = len(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, h, np.int32)), pa.array(np.full(n, part, np.int32)),
             pa.array(np.arange(n, dtype=np.int32)), pa.array(values)],
            names=["h", "part", "at", "v"])


def _added(partial: DataFrame) -> DataFrame:
    return partial.groupBy("h", "part", "at").agg(F.sum("v").alias("v"))


def plain_sums(examples: DataFrame, width: int) -> DataFrame:
    """Product sums of every head and stretch: h, part (the stretch), at, v."""
    upper = np.triu_indices(width + 2)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            rows = _matrix(batch, width)
            key = batch.column("h").to_numpy() * 100_000 + batch.column("since").to_numpy()
            for k in np.unique(key):
                own = rows[key == k]
                found = (own.T @ own)[upper]
                at = (int(k // 100_000), int(k % 100_000))
                sums[at] = sums[at] + found if at in sums else found
        yield from _emit(sums)

    return _added(examples.select("h", "since", "x", "target").mapInArrow(
        add, "h int, part int, at int, v double"))


def robust_sums(examples: DataFrame, width: int, n_folds: int, models: dict) -> DataFrame:
    """The same with Huber's weights under given models: h, part (the fold), at, v; after
    the products come the number of rows and the sum of squared errors cut at the bound."""
    upper = np.triu_indices(width + 2)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            rows, heads = _matrix(batch, width), batch.column("h").to_numpy()
            since = batch.column("since").to_numpy()
            for h in np.unique(heads):
                own, first = rows[heads == h], since[heads == h]
                for fold in range(int(first.min()), n_folds):
                    if (fold, h) not in models:
                        continue
                    beta, sigma = models[fold, h]
                    used = own[first <= fold]
                    bound = max(HUBER_BOUND * sigma, 1e-12)
                    off = np.abs(used[:, -1] - used[:, :-1] @ beta)
                    weighted = used * np.minimum(1.0, bound / np.maximum(off, bound))[:, None]
                    cut = np.minimum(off, bound)
                    found = np.append((weighted.T @ used)[upper], [len(used), cut @ cut])
                    at = (int(h), fold)
                    sums[at] = sums[at] + found if at in sums else found
        yield from _emit(sums)

    return _added(examples.select("h", "since", "x", "target").mapInArrow(
        add, "h int, part int, at int, v double"))


def solved(sums: DataFrame, width: int, n_folds: int, robust: bool, models: dict) -> DataFrame:
    """One model per fold and head. Plain sums are added up over the stretches first;
    ``change`` compares with the given models."""
    size = (width + 2) * (width + 3) // 2
    unpack, solve = kernels.unpack, kernels.solve_spd

    def heads(group: pa.Table) -> pa.Table:
        rows = group.to_pandas()
        h = int(rows.h.iloc[0])
        table = np.zeros((n_folds, size + 2 * robust))
        rows = rows[rows.part < n_folds]
        np.add.at(table, (rows.part.to_numpy(), rows["at"].to_numpy()), rows.v.to_numpy())
        if not robust:
            table = np.cumsum(table, axis=0)
        n, mean, cross = unpack(pd.Series(list(table[:, :size])))
        scale = n[:, None] * np.maximum(mean[:, :-1] ** 2, 1)
        slopes = solve(cross[:, :-1, :-1], cross[:, :-1, -1], scale)
        out = []
        for fold in np.flatnonzero(n > 0):
            b = slopes[fold]
            intercept = mean[fold, -1] - b @ mean[fold, :-1]
            if robust:
                count = table[fold, size]
                sigma = np.sqrt(table[fold, size + 1] / (count * HUBER_SHARE))
            else:
                count = n[fold]
                left = cross[fold, -1, -1] - b @ cross[fold, :-1, -1]
                sigma = np.sqrt(max(left, 0.0) / count)
            change = np.inf
            if (fold, h) in models:
                spread = np.sqrt(np.maximum(np.diag(cross[fold]), 0) / n[fold])
                moved = np.abs(b - models[fold, h][0][1:]) * spread[:-1]
                change = float(moved.max(initial=0.0) / max(spread[-1], 1e-12))
            out.append((int(fold), h, float(intercept), list(map(float, b)), float(sigma),
                        int(round(count)), change))
        solved_ = pd.DataFrame(out, columns=MODEL_SCHEMA.names)
        return pa.Table.from_pandas(solved_, MODEL_SCHEMA, preserve_index=False)

    return sums.groupBy("h").applyInArrow(heads, MODEL)


def fit(examples: DataFrame, inputs: Sequence[str], rolling: Rolling, loss: str = "huber",
        period_col: str = "period", max_iterations: int = MAX_ITERATIONS) -> DataFrame:
    """One row per fold and head: intercept, slopes, sigma, n_rows, iterations, converged.

    ``loss`` is ``huber`` (reweighted until it settles) or ``squared`` (one pass). A fold
    learns from examples whose target lies before its test start. Only the models, bounded
    by folds x heads x inputs, pass through the driver.
    """
    if loss not in ("huber", "squared"):
        raise ValueError(f"unsupported loss: {loss}")
    spark, width = examples.sparkSession, len(inputs)
    n_folds = spark.range(1).select(F.size(rolling.array())).first()[0]
    rows = numbered(examples, inputs, rolling, period_col).filter(
        F.col("target").isNotNull() & (F.col("since") < n_folds))
    rows = cut_lineage(rows.select("h", "since", "x", "target"), "dense")
    found = solved(plain_sums(rows, width), width, n_folds, False, {})
    iterations, settled = 0, loss == "squared"
    while not settled and iterations < max_iterations:
        now = found.collect()
        models = {(m.fold, m.h): (np.array([m.intercept, *m.slopes]), m.sigma) for m in now}
        settled = iterations > 0 and max((m.change for m in now), default=0.0) <= TOLERANCE
        if settled or not models:
            break
        iterations += 1
        found = cut_lineage(solved(robust_sums(rows, width, n_folds, models), width, n_folds,
                                   True, models), "dense-models")
    return found.select("fold", "h", "intercept", "slopes", "sigma", "n_rows",
                        F.lit(iterations).alias("iterations"),
                        F.lit(settled).alias("converged"))


def forecast(examples: DataFrame, models: DataFrame, inputs: Sequence[str], rolling: Rolling,
             days: int, series_col: str = "series", period_col: str = "period") -> DataFrame:
    """Forecast rows of every fold from the last origin before its test start."""
    last = F.filter(rolling.array(), lambda f: (F.col("origin") < f["test_start_date"])
                    & (F.date_add("origin", days) >= f["test_start_date"]))
    rows = numbered(examples, inputs, rolling, period_col)
    rows = rows.select(series_col, period_col, "h", "x", F.explode(last).alias("f"))
    joined = rows.withColumn("fold", F.col("f.fold")).join(models, ["fold", "h"])
    value = F.aggregate(F.zip_with("x", "slopes", lambda x, b: x * b), F.col("intercept"),
                        lambda total, v: total + v)
    return joined.select(
        "fold", series_col, period_col, F.lit("forecast").alias("time_series_type"),
        value.alias("forecast_value"),
        F.lit(None).cast("double").alias("prediction_interval_lower_bound"),
        F.lit(None).cast("double").alias("prediction_interval_upper_bound"))
