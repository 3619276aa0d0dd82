"""Aggregate expressions of the forecast error metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wmape(w_abs_error: str = "wAbsError", w_hist: str = "wHist") -> Column:
    """Errors weighted by the actuals, in percent; NULL when nothing was sold."""
    return F.try_divide(F.sum(w_abs_error).cast("double") * F.lit(100.0),
                        F.sum(w_hist).cast("double"))


def metric_suite(diff: str = "diff", actual: str = "actual_value",
                 w_abs_error: str = "wAbsError", w_hist: str = "wHist") -> list[Column]:
    """All error metrics in one aggregation pass. MAPE is a fraction and skips
    periods with zero actuals; wMAPE is a percentage."""
    err, act = F.col(diff), F.col(actual).cast("double")
    mse = F.avg(err * err)
    return [
        wmape(w_abs_error, w_hist).alias("wMAPE"),
        F.avg(F.try_divide(F.abs(err), act)).alias("MAPE"),
        F.avg(F.abs(err)).alias("MAE"),
        F.try_divide(F.sum(F.abs(err)), F.sum(act)).alias("pMAE"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
        F.try_divide(F.sqrt(mse), F.avg(act)).alias("pRMSE"),
    ]
