"""Rolling-origin folds.

A fold list is a handful of dates, so it is carried as an array *expression*, not
as a table: fanning a row out over folds is an ``explode`` next to the scan, with
no join, and a fold predicate is evaluated before a row is emitted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcast.functions.columns import as_date, period_days, whole_weeks_between

# Split labels and the defaults of the pooled-model path.
TRAIN, VALIDATE, TEST = "TRAIN", "VALIDATE", "TEST"
DEFAULT_HORIZON = 10

FOLD_SCHEMA = T.StructType([
    T.StructField("train_start_date", T.DateType()),
    T.StructField("test_start_date", T.DateType()),
    T.StructField("test_end_date", T.DateType()),
    T.StructField("val_start_date", T.DateType()),
    T.StructField("train_length", T.IntegerType()),
    T.StructField("test_length", T.IntegerType()),
    T.StructField("val_length", T.IntegerType()),
    T.StructField("fold", T.IntegerType()),
])


@dataclass(frozen=True)
class Rolling:
    """Settings of a rolling backtest; ``step`` defaults to ``horizon`` (weeks).

    Windows start at ``test_start`` and every ``step`` weeks after it while the
    start is not after ``test_end``; the last window may run past ``test_end``.
    ``only`` keeps the folds of these numbers, under their numbers.
    """

    train_start: str | Column
    test_start: str | Column
    test_end: str | Column
    horizon: int = DEFAULT_HORIZON
    step: int | None = None
    only: tuple[int, ...] | None = None

    def array(self) -> Column:
        """The folds as ``array<struct>``."""
        weeks = self.step if self.step is not None else self.horizon
        starts = F.sequence(as_date(self.test_start), as_date(self.test_end),
                            F.make_dt_interval(F.lit(7 * weeks)))
        found = F.transform(starts, self._fold)
        if self.only is None:
            return found
        return F.filter(found, lambda f: f["fold"].isin(list(self.only)))

    def _fold(self, start: Column, number: Column) -> Column:
        span = 7 * self.horizon
        train_start, val_start, end = (
            as_date(self.train_start), F.date_sub(start, span), F.date_add(start, span))
        return F.struct(
            train_start.alias("train_start_date"), start.alias("test_start_date"),
            end.alias("test_end_date"), val_start.alias("val_start_date"),
            whole_weeks_between(train_start, val_start).alias("train_length"),
            whole_weeks_between(start, end).alias("test_length"),
            whole_weeks_between(val_start, start).alias("val_length"),
            number.alias("fold"))

    def periods(self, granularity: str = "WEEKLY") -> int:
        """Periods of a test range; the horizon itself counts weeks."""
        return 7 * self.horizon // period_days(granularity)

    def last_day(self) -> Column:
        """No fold needs data after this day."""
        return F.date_add(as_date(self.test_end), 7 * self.horizon)


def fold_table(bounds: DataFrame, rolling: Rolling) -> DataFrame:
    """One row per fold; dates in ``rolling`` may be columns of ``bounds``."""
    return bounds.select(F.inline(rolling.array()))


def stored_folds(folds: DataFrame) -> Column:
    """A fold table read back from storage, as an array expression. A fold list
    has one entry per test window, so bringing it to the driver is bounded."""
    rows = folds.select(*FOLD_SCHEMA.fieldNames()).orderBy("fold").collect()
    return F.array(*[
        F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in FOLD_SCHEMA])
        for r in rows])


def write_folds(folds: DataFrame, path: str) -> None:
    folds.coalesce(1).write.mode("overwrite").json(path)


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FOLD_SCHEMA).json(path)


def _array(folds: Rolling | Column) -> Column:
    return folds.array() if isinstance(folds, Rolling) else folds


def fan_out(df: DataFrame, folds: Rolling | Column, keep=None) -> DataFrame:
    """Repeat each row once per fold ``f`` for which ``keep(f)`` holds."""
    array = _array(folds)
    if keep is not None:
        array = F.filter(array, keep)
    return df.select("*", F.explode(array).alias("f"))


def split_label(time: Column, fold: Column) -> Column:
    return (
        F.when(time < fold["val_start_date"], F.lit(TRAIN))
        .when((time >= fold["val_start_date"]) & (time < fold["test_start_date"]),
              F.lit(VALIDATE))
        .when((time >= fold["test_start_date"]) & (time < fold["test_end_date"]), F.lit(TEST)))


def split_train_test(df: DataFrame, folds: Rolling | Column, time_col: str = "period",
                     split_col: str = "split") -> DataFrame:
    """Label each row for each fold; rows at or after a fold's test end get NULL.

    TRAIN is an expanding window: the train start date does not drop older rows.
    An existing split column is replaced.
    """
    labelled = fan_out(df.drop(split_col), folds)
    return labelled.withColumn(
        split_col, split_label(F.col(time_col).cast("date"), F.col("f"))
    ).withColumn("fold", F.col("f.fold")).drop("f")


def training_rows(labelled: DataFrame, split_col: str = "split") -> DataFrame:
    """Statistical models train on train and validation rows alike."""
    return labelled.filter(F.col(split_col).isin(TRAIN, VALIDATE))


def split_counts(labelled: DataFrame, split_col: str = "split") -> DataFrame:
    return labelled.groupBy("fold", split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def count_splits(df: DataFrame, folds: Rolling | Column, time_col: str = "period",
                 split_col: str = "split") -> DataFrame:
    """``split_counts`` straight from unlabelled rows. A label depends on the period alone,
    so rows are counted per period first and only those counts are fanned out."""
    per_period = df.groupBy(F.col(time_col).cast("date").alias(time_col)).agg(
        F.count(F.lit(1)).alias("n_rows"))
    labelled = split_train_test(per_period, folds, time_col, split_col)
    return labelled.groupBy("fold", split_col).agg(F.sum("n_rows").alias("n_rows"))
