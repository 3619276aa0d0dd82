import datetime as dt

import pytest
from pyspark.sql import functions as F

from foldcast.operators import folds, scaffold
from foldcast.operators.folds import Rolling

D = dt.date
ROLLING = Rolling("2013-07-01", "2016-01-01", "2016-09-26", horizon=10)


def table(spark, rolling):
    return folds.fold_table(spark.range(1), rolling).orderBy("fold").collect()


def test_worked_example(spark):
    rows = table(spark, ROLLING)
    assert [r.test_start_date for r in rows] == [
        D(2016, 1, 1), D(2016, 3, 11), D(2016, 5, 20), D(2016, 7, 29)]
    # Only the start of a window is bounded; the last one runs past the end.
    assert rows[-1].test_end_date == D(2016, 10, 7)
    assert rows[0].val_start_date == D(2015, 10, 23)
    assert [r.train_length for r in rows] == [120, 130, 140, 150]
    assert {(r.test_length, r.val_length) for r in rows} == {(10, 10)}


def test_last_window_may_start_on_the_end_date(spark):
    rows = table(spark, Rolling("2020-01-06", "2021-01-04", "2021-01-18", horizon=4, step=1))
    assert [r.test_start_date for r in rows] == [
        D(2021, 1, 4), D(2021, 1, 11), D(2021, 1, 18)]


def test_training_length_is_floored(spark):
    rows = table(spark, Rolling("2021-01-05", "2021-01-04", "2021-01-04", horizon=1))
    assert rows[0].train_length == -2  # eight days back


def test_split_boundaries_are_half_open(spark):
    rolling = Rolling("2020-01-06", "2021-01-04", "2021-01-04", horizon=1)
    days = {D(2020, 12, 27): "TRAIN", D(2020, 12, 28): "VALIDATE", D(2021, 1, 3): "VALIDATE",
            D(2021, 1, 4): "TEST", D(2021, 1, 10): "TEST", D(2021, 1, 11): None,
            D(1990, 1, 1): "TRAIN"}
    df = spark.createDataFrame([(d, "old") for d in days], "period date, split string")
    got = {r.period: r.split for r in folds.split_train_test(df, rolling).collect()}
    assert got == days


def test_each_row_gets_one_label_per_fold_and_counts_add_up(spark):
    df = spark.sql("SELECT explode(sequence(date'2015-01-01', date'2017-01-01', "
                   "interval 3 days)) AS period")
    labelled = folds.split_train_test(df, ROLLING)
    assert labelled.groupBy("fold", "period").count().filter("count > 1").count() == 0
    per_fold = folds.split_counts(labelled).groupBy("fold").agg(F.sum("n_rows").alias("n"))
    assert {r.n for r in per_fold.collect()} == {df.count()}
    assert sorted(folds.count_splits(df, ROLLING).collect(), key=str) == sorted(
        folds.split_counts(labelled).collect(), key=str)
    train = folds.training_rows(labelled)
    assert {r.split for r in train.select("split").distinct().collect()} == {
        "TRAIN", "VALIDATE"}


def test_stored_folds_round_trip(spark, tmp_path):
    path = str(tmp_path / "folds")
    original = folds.fold_table(spark.range(1), ROLLING)
    folds.write_folds(original, path)
    stored = folds.read_folds(spark, path)
    assert stored.schema == folds.FOLD_SCHEMA
    assert sorted(stored.collect()) == sorted(original.collect())
    df = spark.createDataFrame([(D(2016, 1, 4),)], "period date")
    a = folds.split_train_test(df, folds.stored_folds(stored)).collect()
    assert sorted(a) == sorted(folds.split_train_test(df, ROLLING).collect())


@pytest.mark.parametrize("align,inclusive,first,n", [
    (True, True, D(2016, 1, 4), 10), (False, True, D(2016, 1, 1), 11),
    (False, False, D(2016, 1, 1), 10)])
def test_scaffold_dates(spark, align, inclusive, first, n):
    panel = spark.createDataFrame(
        [("a", D(2016, 1, 4), 3), ("b", D(2015, 1, 5), 1)],
        "series string, period date, qty bigint")
    one = Rolling("2013-07-01", "2016-01-01", "2016-01-01", horizon=10)
    grid = scaffold.date_scaffold(panel, one, align=align, end_inclusive=inclusive)
    assert grid.count() == 2 * n
    assert grid.agg(F.min("period")).collect()[0][0] == first
    actual = scaffold.scaffold_actuals(panel, one, align=align, end_inclusive=inclusive)
    assert actual.agg(F.sum("qty")).collect()[0][0] == (3 if align else 0)


def test_scaffold_end_date_has_no_actual(spark):
    panel = spark.createDataFrame([("a", D(2021, 1, 4), 3), ("a", D(2021, 1, 11), 4)],
                                  "series string, period date, qty bigint")
    one = Rolling("2020-01-06", "2021-01-04", "2021-01-04", horizon=1)
    rows = scaffold.scaffold_actuals(panel, one).collect()
    assert {(r.period, r.qty) for r in rows} == {(D(2021, 1, 4), 3), (D(2021, 1, 11), 0)}


def test_daily_scaffold_steps_by_day(spark):
    panel = spark.createDataFrame([("a", D(2021, 1, 1), 3)],
                                  "series string, period date, qty bigint")
    one = Rolling("2020-01-06", "2021-01-01", "2021-01-01", horizon=1)
    assert scaffold.date_scaffold(panel, one, granularity="DAILY").count() == 8


def test_fractional_actuals_keep_their_type(spark):
    panel = spark.createDataFrame([("a", dt.date(2020, 1, 6), 2.5)], "series string, period date, qty double")
    one = Rolling("2019-01-07", "2020-01-06", "2020-01-06", horizon=1)
    rows = scaffold.scaffold_actuals(panel, one).orderBy("period").collect()
    assert [r.qty for r in rows] == [2.5, 0.0]
