"""Pooled ("global") models: one model learns from the windows of all series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcast.functions.columns import period_days
from foldcast.operators import boost, dense
from foldcast.operators.folds import Rolling
from foldcast.operators.panel import enrich, fill_gaps, spread
from foldcast.sources.scratch import cut_lineage


def window_examples(panel: DataFrame, context: int, horizon: int,
                    known: DataFrame | None = None, unknown: Sequence[str] = (),
                    attributes: Sequence[str] = (), series_col: str = "series",
                    period_col: str = "period", target_col: str = "qty",
                    granularity: str = "WEEKLY", known_from_panel: Sequence[str] = ()
                    ) -> DataFrame:
    """One row per (series, origin, h): the ``context`` last targets as ``lag_1`` (at the
    origin itself) to ``lag_<context>``, and the target h periods on.

    ``known`` is a calendar whose covariates are taken at the target's period;
    ``known_from_panel`` columns are the series' own, at the target's period too.
    ``unknown`` columns of the panel are only taken at the origin, so that nothing after
    the origin leaks in. Origins without a full context are left out. The panel must be
    regular; lags and leads then come from one window per series, with no self-join.
    """
    w = Window.partitionBy(series_col).orderBy(period_col)
    leads = F.array(*[F.lead(F.col(target_col).cast("double"), h).over(w)
                      for h in range(1, horizon + 1)])
    lags = {f"lag_{i}": F.lag(target_col, i - 1).over(w) for i in range(1, context + 1)}
    ahead = {f"__{c}_ahead": F.array(*[F.lead(c, h).over(w) for h in range(1, horizon + 1)])
             for c in known_from_panel}
    rows = panel.withColumns({**lags, "__leads": leads, **ahead}).filter(
        F.col(f"lag_{context}").isNotNull())
    rows = rows.select(
        series_col, F.col(period_col).alias("origin"), *lags, *attributes,
        *[F.col(c).alias(f"{c}_at_origin") for c in unknown], *ahead,
        F.posexplode("__leads").alias("h", "target"))
    rows = rows.withColumns({c: F.col(f"__{c}_ahead")[F.col("h")] for c in known_from_panel})
    rows = rows.drop(*ahead)
    days = period_days(granularity)
    rows = rows.withColumn("h", F.col("h") + 1).withColumn(
        period_col, F.expr(f"date_add(origin, h * {days})"))
    return rows if known is None else enrich(rows, known, period_col, "period")


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """One row per period with a holiday: a 0/1 column for each holiday of the calendar,
    whose names are a fixed list."""
    names = sorted(r[0] for r in holidays.select("holiday").distinct().collect())
    return holidays.groupBy("period").agg(*[
        F.max((F.col("holiday") == n).cast("int")).alias(
            "holiday_" + "".join(c if c.isalnum() else "_" for c in n.lower())) for n in names])


def prepared_examples(panel: DataFrame, rolling: Rolling, context: int = 20,
                      known: DataFrame | None = None, unknown: Sequence[str] = (),
                      attributes: Sequence[str] = (), series_col: str = "series",
                      period_col: str = "period", target_col: str = "qty",
                      granularity: str = "WEEKLY", holidays: DataFrame | None = None,
                      known_from_panel: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Examples of all folds, written to the shared scratch folder once, and the names of
    their inputs."""
    grid = fill_gaps(spread(panel, series_col), series_col, period_col, target_col, granularity,
                     end=F.date_sub(rolling.last_day(), 1), attribute_cols=attributes,
                     varying_cols=[*unknown, *known_from_panel])
    examples = window_examples(grid, context, rolling.periods(granularity), known, unknown,
                               attributes, series_col, period_col, target_col, granularity,
                               known_from_panel)
    if holidays is not None:
        flags = holiday_flags(holidays)
        names = [c for c in flags.columns if c != "period"]
        examples = enrich(examples, flags, period_col, "period").fillna(0, names)
    examples = examples.withColumns({"week_of_year": F.weekofyear(period_col),
                                     "month": F.month(period_col)})
    inputs = [c for c in examples.columns
              if c not in (series_col, "origin", "target", period_col)]
    examples = examples.withColumns({
        c: F.col(c).cast("double") for c in inputs
        if isinstance(examples.schema[c].dataType, T.NumericType)})
    return cut_lineage(examples, "examples"), inputs


def as_numbers(examples: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Text inputs as their rank by frequency, the commonest first."""
    text = [c for c in inputs if isinstance(examples.schema[c].dataType, T.StringType)]
    if not text:
        return examples
    indexer = StringIndexer(inputCols=text, outputCols=[f"{c}__in" for c in text],
                            handleInvalid="keep").fit(examples)
    return indexer.transform(examples).drop(*text).withColumnsRenamed(
        {f"{c}__in": c for c in text})


def dense_models(examples: DataFrame, inputs: Sequence[str], rolling: Rolling,
                 loss: str = "huber", period_col: str = "period") -> DataFrame:
    """The direct linear model of every fold and step ahead, and how it was reached."""
    used = [c for c in inputs if c != "h"]
    heads = as_numbers(examples, used).withColumn("h", F.col("h").cast("int"))
    return dense.fit(heads, used, rolling, loss, period_col)


def boosted_trees(examples: DataFrame, inputs: Sequence[str], rolling: Rolling,
                  rounds: int = 30, period_col: str = "period"
                  ) -> tuple[DataFrame, list, dict[int, boost.Forest]]:
    """Examples in numbers, bin edges, and the boosted trees of every fold."""
    numbers = as_numbers(examples, inputs)
    return (numbers, *boost.fit(numbers, inputs, rolling, rounds, period_col))


def fit_and_forecast(panel: DataFrame, rolling: Rolling, kind: str, context: int = 20,
                     known: DataFrame | None = None, unknown: Sequence[str] = (),
                     attributes: Sequence[str] = (), series_col: str = "series",
                     period_col: str = "period", target_col: str = "qty",
                     granularity: str = "WEEKLY", rounds: int = 30,
                     holidays: DataFrame | None = None, known_from_panel: Sequence[str] = ()
                     ) -> DataFrame:
    """Fit one pooled model per fold and forecast the fold's test range from its last
    training period.

    Examples are written to the shared scratch folder once. Both kinds fit all folds
    together: the dense encoder from sums of products, boosted trees from histograms of at
    most ``rounds`` rounds, fewer where a fold's validation rows say so.
    """
    # Example columns do not depend on the model; an unknown kind fails before any work.
    if kind not in ("dense_encoder", "learn_to_learn"):
        raise ValueError(f"unsupported model: {kind}")
    days = period_days(granularity)
    examples, inputs = prepared_examples(
        panel, rolling, context, known, unknown, attributes, series_col, period_col, target_col,
        granularity, holidays, known_from_panel)
    if kind == "dense_encoder":
        used = [c for c in inputs if c != "h"]
        heads = as_numbers(examples, used).withColumn("h", F.col("h").cast("int"))
        models = dense.fit(heads, used, rolling, period_col=period_col)
        return dense.forecast(heads, models, used, rolling, days, series_col, period_col)
    numbers, edges, forests = boosted_trees(examples, inputs, rolling, rounds, period_col)
    return boost.forecast(numbers, edges, forests, inputs, rolling, days, series_col, period_col)
