"""Backtests that go on where they were stopped.

A manifest beside the dashboard names the finished folds of each run and model. Folds are
anti-joined to it before anything is fitted. Rows replace their own (run, model, fold)
partition and the manifest follows them, so a run that dies in between writes the same
partition again: nothing is appended twice and nothing is read half-written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcast.operators import baseline, score
from foldcast.operators.folds import Rolling, fold_table
from foldcast.sources import tables

KEYS = ["run_name", "model_name", "fold"]
MANIFEST = "run_name string, model_name string, fold int, n_rows bigint"


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table, without rows where nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Finished folds of all runs and models; none where nothing was stored yet."""
    return _read(spark, f"{root}/manifest", MANIFEST).dropDuplicates(KEYS)


def pending_folds(spark: SparkSession, rolling: Rolling, root: str, run_name: str,
                  model_name: str) -> list[int]:
    """Numbers of the folds still to be fitted (a fold list has one entry per test window)."""
    done = manifest(spark, root).filter(
        (F.col("run_name") == run_name) & (F.col("model_name") == model_name))
    left = fold_table(spark.range(1), rolling).join(done, "fold", "left_anti")
    return [r.fold for r in left.select("fold").orderBy("fold").collect()]


def resume(panel: DataFrame, rolling: Rolling, run_name: str, model_name: str,
           forecast: Callable[[DataFrame, Rolling], DataFrame], root: str,
           at_once: int | None = None, most: int | None = None) -> DataFrame:
    """Fit the folds that the manifest does not name, ``at_once`` in one plan (all, unless
    given) and at most ``most`` in this call; return the run's finished dashboard rows.

    The panel must be the one the run began with: finished folds are not fitted again. A
    fold without rows is finished too.
    """
    spark = panel.sparkSession
    left = pending_folds(spark, rolling, root, run_name, model_name)[:most]
    size = at_once or max(len(left), 1)
    # Rows that every model has in common; only their columns are looked at.
    schema = _rows(panel, rolling, run_name, model_name, baseline.seasonal_naive).schema
    for at in range(0, len(left), size):
        part = replace(rolling, only=tuple(left[at:at + size]))
        rows = _rows(panel, part, run_name, model_name, forecast)
        tables.replace_partitions(rows, f"{root}/dashboard", KEYS)
        _finish(_of_run(spark, root, run_name, model_name, schema), root, run_name,
                model_name, part)
    return finished(spark, root, run_name, model_name, schema)


def _rows(panel: DataFrame, rolling: Rolling, run_name: str, model_name: str,
          forecast: Callable[[DataFrame, Rolling], DataFrame]) -> DataFrame:
    rows = score.dashboard_rows(panel, forecast(panel, rolling), rolling, model_name, run_name)
    return rows.withColumn("run_name", F.lit(run_name))


def _of_run(spark: SparkSession, root: str, run_name: str, model_name: str,
            schema: T.StructType) -> DataFrame:
    return _read(spark, f"{root}/dashboard", schema).filter(
        (F.col("run_name") == run_name) & (F.col("model_name") == model_name))


def _finish(stored: DataFrame, root: str, run_name: str, model_name: str, part: Rolling
            ) -> None:
    counts = stored.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))
    folds = fold_table(stored.sparkSession.range(1), part).select("fold")
    folds.join(counts, "fold", "left").select(
        F.lit(run_name).alias("run_name"), F.lit(model_name).alias("model_name"), "fold",
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")
    ).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def finished(spark: SparkSession, root: str, run_name: str, model_name: str,
             schema: T.StructType) -> DataFrame:
    """Dashboard rows (of the given columns) of the folds that the manifest names."""
    rows = _of_run(spark, root, run_name, model_name, schema)
    done = manifest(spark, root).select(*KEYS)
    return rows.join(done, KEYS, "left_semi").drop("run_name")
