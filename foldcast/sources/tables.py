"""Readers and writers.

Everything is lazy on the read side, so Catalyst prunes columns and pushes
filters into the parquet scan. Writers never overwrite a path they read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows under a total order (planned as a distributed top-k)."""
    return df.orderBy(*order_by).limit(n)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  cluster_by: Sequence[str] = ()) -> DataFrame:
    """Create-or-replace a stored table and return a reader over it.

    ``cluster_by`` range-partitions and sorts the files, which gives readers
    tight min/max statistics without a global total sort in the plan.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def append_table(df: DataFrame, path: str,
                 partition_by: Sequence[str] = ("model_name", "fold")) -> None:
    """Append rows to a stored table, keeping what earlier runs wrote."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Read an append-only table whose later batches may have added columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_allow_new_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL by name; columns absent on one side are NULL there."""
    return left.unionByName(right, allowMissingColumns=True)


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    """Star-except; absent columns are ignored."""
    return df.drop(*columns)


def run_log(df: DataFrame, run_col: str, params: dict[str, object],
            metric_cols: Sequence[str]) -> DataFrame:
    """One row per run with a string-to-string map of parameters and a
    string-to-double map of metrics taken from ``metric_cols``."""
    param_pairs = [F.lit(x) for k, v in sorted(params.items()) for x in (k, str(v))]
    metric_pairs = [x for c in metric_cols for x in (F.lit(c), F.col(c).cast("double"))]
    empty = F.create_map().cast("map<string,string>")
    return df.select(
        F.col(run_col),
        (F.create_map(*param_pairs) if param_pairs else empty).alias("params"),
        F.create_map(*metric_pairs).alias("metrics"),
    )
