"""Forecast-accuracy metrics as aggregate ``Column`` builders (AG-1..AG-12, UD-3).

Each builder is a plain Spark aggregate, so one ``groupBy(...).agg(...)``
computes every metric for every (model, series, fold) group in a single
pass with map-side partial aggregation.  The only exact-order statistic is
the median (``median_ae``), which Spark computes exactly per group.

Conventions of the reference kept here: ``forecast_bias`` is the mean of
predicted minus actual, MAPE/MRE ignore zero actuals and are +inf when none
are left, sMAPE counts 0/0 as 0, R^2 is 1 - SSE/SST with SST = 0 giving 1
(perfect) or 0, and directional accuracy compares strict rises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import INF, col_

# Metric names in the reference's report order.
CORE_METRICS = ["mae", "rmse", "mape", "smape", "r2", "median_ae", "mre"]
ERROR_ANALYSIS_METRICS = ["directional_accuracy", "forecast_bias"]
ALL_METRICS = CORE_METRICS + ERROR_ANALYSIS_METRICS


def _e(y, yhat) -> Column:
    return col_(y) - col_(yhat)


def mae(y="y", yhat="yhat") -> Column:
    return F.avg(F.abs(_e(y, yhat)))


def rmse(y="y", yhat="yhat") -> Column:
    e = _e(y, yhat)
    return F.sqrt(F.avg(e * e))


def _relative_abs_error(y, yhat) -> Column:
    y = col_(y)
    return F.when(y != 0, F.abs((y - col_(yhat)) / y))


def mre(y="y", yhat="yhat") -> Column:
    return F.when(F.count(_relative_abs_error(y, yhat)) == 0, F.lit(INF)).otherwise(
        F.avg(_relative_abs_error(y, yhat)))


def mape(y="y", yhat="yhat") -> Column:
    return F.when(F.count(_relative_abs_error(y, yhat)) == 0, F.lit(INF)).otherwise(
        F.avg(_relative_abs_error(y, yhat)) * 100.0)


def smape(y="y", yhat="yhat") -> Column:
    y, yhat = col_(y), col_(yhat)
    den = (F.abs(y) + F.abs(yhat)) / 2.0
    return F.avg(F.coalesce(F.try_divide(F.abs(y - yhat), den), F.lit(0.0))) * 100.0


def r2(y="y", yhat="yhat") -> Column:
    e = _e(y, yhat)
    sse = F.sum(e * e)
    sst = F.var_pop(col_(y)) * F.count(col_(y))
    return (
        F.when(F.count(col_(y)) < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(1.0 - sse / sst)
    )


def median_ae(y="y", yhat="yhat") -> Column:
    return F.median(F.abs(_e(y, yhat)))


def forecast_bias(y="y", yhat="yhat") -> Column:
    return F.avg(col_(yhat) - col_(y))


def direction_match(y="y", yhat="yhat", y_prev="y_prev", yhat_prev="yhat_prev") -> Column:
    """Row-level: did actual and forecast move the same way (rise vs not rise)?

    NULL on the first row of a group, so it drops out of the n-1 denominator.
    """
    up_y = (col_(y) - col_(y_prev)) > 0
    up_f = (col_(yhat) - col_(yhat_prev)) > 0
    return (up_y == up_f).cast("double")


def directional_accuracy(match="dir_match") -> Column:
    return F.avg(col_(match)) * 100.0


def metric_columns(y="y", yhat="yhat", match="dir_match",
                   include_error_analysis: bool = True,
                   only: list[str] | None = None) -> list[Column]:
    """All metrics of ``calculate_all_metrics`` as aliased aggregates (AG-10, DK-12)."""
    cols = {
        "mae": mae(y, yhat),
        "rmse": rmse(y, yhat),
        "mape": mape(y, yhat),
        "smape": smape(y, yhat),
        "r2": r2(y, yhat),
        "median_ae": median_ae(y, yhat),
        "mre": mre(y, yhat),
    }
    if include_error_analysis:
        cols["directional_accuracy"] = directional_accuracy(match)
        cols["forecast_bias"] = forecast_bias(y, yhat)
    names = [n for n in cols if only is None or n in only]
    return [cols[n].alias(n) for n in names]


def error_analysis_columns(y="y", yhat="yhat") -> list[Column]:
    """``analyze_errors`` (AG-12): e = actual - predicted, population std."""
    e = col_(y) - col_(yhat)
    return [
        F.avg(e).alias("mean_error"),
        F.stddev_pop(e).alias("std_error"),
        F.min(e).alias("min_error"),
        F.max(e).alias("max_error"),
        F.count_if(e > 0).alias("positive_errors"),
        F.count_if(e < 0).alias("negative_errors"),
        F.percentile(e, F.lit(0.25)).alias("q25"),
        F.percentile(e, F.lit(0.50)).alias("q50"),
        F.percentile(e, F.lit(0.75)).alias("q75"),
    ]
