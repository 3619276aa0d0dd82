"""Scalar column expressions: keys, periods, clamps, errors, labels."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and bounds that reports built on these columns expect.
GRANULARITY_DAYS = {"WEEKLY": 7, "WEEK": 7, "DAILY": 1, "DAY": 1}
HISTORY_BUCKETS = [
    # (label, lowest number of days, highest number of days)
    ("More than 3 years", 1096, None),
    ("Between 2 and 3 years", 730, 1095),
    ("Between 1 and 2 years", 365, 729),
    ("Between 6 months and 1 year", 182, 364),
    ("Less than 6 months", None, 181),
]
GLOBAL_MODEL_PREFIX = {"learn_to_learn": "l2l", "dense_encoder": "tide"}
MULTIPLICATIVE_ZERO = 0.01


def period_days(granularity: str) -> int:
    """Length of one period in days; unknown granularities are an error."""
    try:
        return GRANULARITY_DAYS[granularity.upper()]
    except KeyError:
        raise ValueError(f"unsupported granularity: {granularity}") from None


def as_date(value: str | Column) -> Column:
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def normalise(name: str | Column) -> Column:
    """Lower-case and keep letters, digits and hyphens only."""
    col = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(F.lower(col), "[^a-z0-9-]", "")


def series_id(*parts: str | Column) -> Column:
    """Normalised parts joined by ``_``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), normalise(part)]
    return F.concat(*pieces[1:])


def period_start(time: str | Column, granularity: str) -> Column:
    """The DATE of the Monday (weekly) or the day (daily) that ``time`` is in."""
    day = (F.col(time) if isinstance(time, str) else time).cast("date")
    return F.trunc(day, "week") if period_days(granularity) == 7 else day


def on_or_after_monday(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "Mon")


def clamp(value: str | Column) -> Column:
    """NULL and negative values become 0."""
    col = F.col(value) if isinstance(value, str) else value
    return F.greatest(F.coalesce(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def limit(value: Column, lower: float | None, upper: float | None) -> Column:
    out = value
    if lower is not None:
        out = F.when(out < lower, F.lit(float(lower))).otherwise(out)
    if upper is not None:
        out = F.when(out > upper, F.lit(float(upper))).otherwise(out)
    return out


def weighted_abs_error(actual: Column, forecast: Column) -> Column:
    return F.abs(actual - forecast) * actual


def lag_index(day: str | Column, start: Column, granularity: str) -> Column:
    """Periods from ``start``, rounded half away from zero."""
    col = F.col(day) if isinstance(day, str) else day
    return F.round(F.datediff(col, start) / F.lit(float(period_days(granularity))))


def whole_weeks_between(start: Column, end: Column) -> Column:
    return F.floor(F.datediff(end, start) / F.lit(7)).cast("int")


def history_bucket(days: str | Column) -> Column:
    return _by_history_bucket(days, lambda rank, label: F.lit(label))


def history_bucket_rank(days: str | Column) -> Column:
    return _by_history_bucket(days, lambda rank, label: F.lit(rank))


def _by_history_bucket(days, value) -> Column:
    col = F.col(days) if isinstance(days, str) else days
    chain = None
    for rank, (label, low, _) in enumerate(HISTORY_BUCKETS, start=1):
        if low is None:
            return chain.otherwise(value(rank, label))
        test = col >= low
        chain = F.when(test, value(rank, label)) if chain is None else chain.when(
            test, value(rank, label))
    return chain


def run_id(run_name: str | Column) -> Column:
    """The run a fold run belongs to: the text before ``-fold-``."""
    col = F.col(run_name) if isinstance(run_name, str) else run_name
    return F.split(col, "-fold-").getItem(0)


def fold_run_name(run: str | Column, fold: str | Column) -> Column:
    run = F.lit(run) if isinstance(run, str) else run
    fold = F.col(fold) if isinstance(fold, str) else fold
    return F.concat(run, F.lit("-fold-"), fold.cast("string"))


def global_model_name(kind: str, context_window: int, experiment: str,
                      run_name: Column) -> Column:
    """Display name of a pooled model; unknown kinds are an error."""
    if kind not in GLOBAL_MODEL_PREFIX:
        raise ValueError(f"unsupported model: {kind}")
    stem = f"{GLOBAL_MODEL_PREFIX[kind]}_context{context_window}_{experiment}_"
    return F.concat(F.lit(stem), run_name)


def to_bigint(value: str | Column) -> Column:
    """Cast with rounding half away from zero, also from text."""
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col.cast("double")).cast("bigint")


def replace_zero(value: Column, by: float = MULTIPLICATIVE_ZERO) -> Column:
    return F.when(value == 0, F.lit(by)).otherwise(value.cast("double"))


def z_value(confidence: float) -> float:
    """Two-sided normal quantile of an interval with this coverage."""
    return NormalDist().inv_cdf((1 + confidence) / 2)
