"""Shapes of the physical plans that keep the queries scalable."""

import re

import pytest

from foldcast.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
ITERATIVE = {"global_gbt", "global_gbt_coverage", "global_linear",
             "global_linear_coverage"}  # these run jobs while the plan is built
STORED = {"dashboard_append", "dashboard_merge_schema", "evaluated_items",
          "folds_json_roundtrip"}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE - STORED))
def test_no_cross_joins_and_no_row_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "FlatMapGroupsInPandas" not in text
    if name not in {"arima_auto", "arima_auto_models", "arima_auto_explain",
                    "arima_auto_training_info", "xreg_multi"}:
        assert "Python" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "weekly_panel")
    schema = re.search(r"ReadSchema: (struct<l_orderkey[^>]*>)", text).group(1)
    assert schema == ("struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,"
                      "l_shipdate:timestamp_ntz>")
    assert "l_orderkey" not in plan(spark, "seasonal_decompose")


def test_time_filters_reach_the_scan(spark):
    from foldcast.operators import panel as P
    from foldcast.sources.tables import read_table
    items = read_table(spark, SF, "lineitem")
    rolled = P.roll_up(items, "l_shipdate", ["l_partkey"], "l_orderkey", start="2000-01-03")
    text = rolled._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,2000-01-03" in text


def test_an_arima_fit_shuffles_rows_once_by_series(spark):
    text = plan(spark, "arima_closed_form")
    by_series = re.findall(r"Exchange hashpartitioning\(series#\d+, \d+\)", text)
    by_fold = re.findall(r"Exchange hashpartitioning\(series#\d+, fold", text)
    assert len(by_series) == 1 and not by_fold


def test_one_series_is_filtered_before_the_models(spark):
    from foldcast.operators import arima
    from foldcast.sources import bindings as B
    fitted = arima.fit(arima.fold_grid(B.core_panel(spark, SF), B.ROLLING))
    one = arima.explain(fitted).filter("series = 'nation3_nation15'")
    text = one._jdf.queryExecution().optimizedPlan().toString()
    assert text.rindex("nation3_nation15") > text.rindex("Window ")
