"""Bindings of the driver's tables to the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.functions.columns import period_start
from foldcast.operators import panel as P
from foldcast.operators.folds import Rolling
from foldcast.sources.scratch import cut_lineage
from foldcast.sources.tables import read_table

# The test period of the rolling backtests on these tables.
FIRST_PERIOD, LAST_PERIOD = "1995-01-02", "2001-10-29"
ROLLING = Rolling(FIRST_PERIOD, "2000-01-03", LAST_PERIOD, horizon=10, step=10)
EARLY = Rolling(FIRST_PERIOD, "1995-07-03", "1995-09-04", horizon=10, step=10)
OFF_GRID = Rolling(FIRST_PERIOD, "2000-01-07", LAST_PERIOD, horizon=10, step=10)
ATTRIBUTES = ["origin_id", "origin_region", "dest_id", "dest_region"]


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip, with the keys of its origin and destination only."""
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers first, so the item rows are shuffled once for both.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("origin_id"))
    return (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("l_shipdate").alias("event_ts"), F.col("l_partkey").alias("unit_id"),
                "origin_id", F.col("s_nationkey").alias("dest_id")))


def _name_places(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    for side in ("origin", "dest"):
        place = nation.select(F.col("n_nationkey").alias(f"{side}_id"),
                              F.col("n_name").alias(f"{side}_name"),
                              F.col("n_regionkey").alias(f"{side}_region"))
        df = df.join(place, f"{side}_id")
    return df


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event table: one timestamped trip between two named places per row."""
    return _name_places(spark, sf_dir, _facts(spark, sf_dir))


def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per (week, origin_destination series).

    Trips are counted by place keys first; names and series ids are worked out on
    the few rows left, and places whose names normalise alike are merged there.
    """
    counted = P.roll_up(_facts(spark, sf_dir), "event_ts", ["origin_id", "dest_id"], "unit_id")
    named = P.with_series_id(_name_places(spark, sf_dir, counted), ["origin_name", "dest_name"])
    return P.merge_periods(named, attribute_cols=ATTRIBUTES + ["origin_name", "dest_name"])


def core_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three columns a forecaster needs."""
    return weekly_panel(spark, sf_dir).select("series", "period", "qty")


def prepared_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly panel, stored. A step that reads the panel more than once starts from
    here: the raw tables are joined and counted once, and what is read again is the
    far smaller panel."""
    return cut_lineage(weekly_panel(spark, sf_dir), "panel")


def total_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips per week as one series. Counted straight from the events: the sum
    over all series needs none of the joins that name them."""
    items = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_partkey")
    return P.roll_up(items, "l_shipdate", [], "l_partkey").select(
        F.lit("total").alias("series"), "period", "qty")


def origin_panel(spark: SparkSession, sf_dir: str, regions: bool = False) -> DataFrame:
    """Trips per week and origin: few, dense series."""
    region = [F.min("origin_region").alias("origin_region")] if regions else []
    return (weekly_panel(spark, sf_dir).groupBy(F.col("origin_name").alias("series"), "period")
            .agg(F.sum("qty").alias("qty"), *region))


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (day, user)."""
    events = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_id")
    return P.roll_up(events, "ts", ["user_id"], "event_id", granularity="DAILY").select(
        F.col("user_id").cast("string").alias("series"), "period", "qty")


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (week, customer_priority): short histories of many lengths."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    counted = P.roll_up(orders, "o_orderdate", ["o_custkey", "o_orderpriority"], "o_orderkey")
    return counted.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), "o_orderpriority")
        .alias("series"), "period", "qty")


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per (week, part): many sparse series."""
    items = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_partkey", "l_orderkey")
    return P.roll_up(items, "l_shipdate", ["l_partkey"], "l_orderkey").select(
        F.col("l_partkey").cast("string").alias("series"), "period", "qty")


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last week with a trip, from the scan's time column alone."""
    items = read_table(spark, sf_dir, "lineitem").select("l_shipdate")
    return items.agg(
        period_start(F.min("l_shipdate"), "WEEKLY").alias("first_period"),
        period_start(F.max("l_shipdate"), "WEEKLY").alias("last_period"))


def rain(period: str | Column) -> Column:
    """A covariate any engine can reproduce: a fixed function of the week number."""
    col = F.col(period) if isinstance(period, str) else period
    week = F.floor(F.datediff(col, F.lit(FIRST_PERIOD).cast("date")) / 7)
    return (week * 37 + 11) % 101 / F.lit(100.0)


def weather(spark: SparkSession, sf_dir: str, panel: DataFrame | None = None) -> DataFrame:
    """Calendar of the covariate over the weeks that have trips; those of a stored panel,
    where there is one, so that the events are not read again."""
    bounds = event_bounds(spark, sf_dir) if panel is None else panel.agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    spine = P.period_spine(bounds, F.col("first_period"), F.col("last_period"))
    return spine.withColumn("percentage_rain", rain("period"))
