import datetime as dt

import pytest
from pyspark.sql import functions as F

from foldcast.functions import columns as C
from foldcast.operators import panel as P
from foldcast.operators import profile
from foldcast.sources import tables

D = dt.date


def test_series_id_normalises_and_propagates_null(spark):
    df = spark.createDataFrame(
        [("1 Ave & E-30 St", "St. Marks Pl"), (None, "x")], "a string, b string")
    got = [r.series for r in P.with_series_id(df, ["a", "b"]).collect()]
    assert got == ["1avee-30st_stmarkspl", None]


def test_roll_up_counts_non_null_and_starts_weeks_on_monday(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", 1, "s"), ("2024-01-07 23:59:59", 2, "s"),
         ("2024-01-07 12:00:00", None, "s"), ("2024-01-08 00:00:00", 3, "s")],
        "ts string, unit int, k string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.period: r.qty for r in P.roll_up(df, "ts", ["k"], "unit").collect()}
    assert got == {D(2024, 1, 1): 2, D(2024, 1, 8): 1}
    cut = P.roll_up(df, "ts", ["k"], "unit", start="2024-01-08", end="2024-01-15")
    assert [r.qty for r in cut.collect()] == [1]


def test_unknown_granularity_is_an_error():
    with pytest.raises(ValueError):
        C.period_days("MONTHLY")


def test_fill_gaps(spark):
    panel = spark.createDataFrame(
        [("a", D(2024, 1, 1), 5), ("a", D(2024, 1, 22), 7), ("b", D(2024, 1, 15), 1)],
        "series string, period date, qty bigint")
    got = {(r.series, r.period): r.qty for r in P.fill_gaps(panel, end="2024-01-29").collect()}
    assert got == {
        ("a", D(2024, 1, 1)): 5, ("a", D(2024, 1, 8)): 0, ("a", D(2024, 1, 15)): 0,
        ("a", D(2024, 1, 22)): 7, ("a", D(2024, 1, 29)): 0,
        ("b", D(2024, 1, 15)): 1, ("b", D(2024, 1, 22)): 0, ("b", D(2024, 1, 29)): 0}
    early = P.fill_gaps(panel, start="2023-12-25", end="2024-01-08").collect()
    assert {(r.series, r.period, r.qty) for r in early} == {
        ("a", D(2023, 12, 25), 0), ("a", D(2024, 1, 1), 5), ("a", D(2024, 1, 8), 0),
        ("b", D(2023, 12, 25), 0), ("b", D(2024, 1, 1), 0), ("b", D(2024, 1, 8), 0)}
    gaps = P.fill_gaps(panel, gap_value=None).filter("qty IS NULL").count()
    assert gaps == 2


def test_history_bucket_bounds(spark):
    days = [1096, 1095, 730, 729, 365, 364, 182, 181, 0]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r.r for r in df.select(C.history_bucket_rank("d").alias("r")).collect()]
    assert got == [1, 2, 2, 3, 3, 4, 4, 5, 5]


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 7 + [1.0],
                                    [float(i * i % 17) for i in range(100)], [None, 4.0]])
def test_exact_median(spark, values):
    import statistics
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = profile.exact_medians(df, ["x"]).collect()[0].median
    assert got == statistics.median([v for v in values if v is not None])


def test_missing_values_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: r.value_count for r in profile.missing_values(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_append_allows_new_columns_and_keeps_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("m", 0, 1.0)], "model_name string, fold int, x double")
    second = spark.createDataFrame([("m", 1, 2.0, "new")],
                                   "model_name string, fold int, x double, extra string")
    tables.append_table(first, path)
    tables.append_table(second, path)
    got = {(r.fold, r.x, r.extra) for r in tables.read_appended(spark, path).collect()}
    assert got == {(0, 1.0, None), (1, 2.0, "new")}


def test_replace_table_and_namespace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    assert tables.replace_table(spark.range(3), path, cluster_by=["id"]).count() == 3
    tables.create_namespace(spark, "foldcast_test_ns")
    tables.create_namespace(spark, "foldcast_test_ns")
    assert spark.catalog.databaseExists("foldcast_test_ns")
    spark.sql("DROP DATABASE foldcast_test_ns")


def test_run_log(spark):
    df = spark.createDataFrame([("r-fold-0", 1.5, 2.0)], "run string, a double, b double")
    row = tables.run_log(df, "run", {"horizon": 10}, ["a", "b"]).collect()[0]
    assert row.params == {"horizon": "10"} and row.metrics == {"a": 1.5, "b": 2.0}
