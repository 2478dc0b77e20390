"""Naive and seasonal-naive forecasters (the baselines the CV flagship scores).

``context='with_history'``: the forecast for day t is the value ``season``
rows earlier in the whole series, so the first test rows of a fold look
back into its training years.  ``context='test_only'`` mirrors a model that
only sees the test rows (the reference's prediction context): the first
``season`` test rows of each fold have no forecast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import DS, Y, by_series, keys_of
from .splits import DEFAULT_MAX_FOLDS, expand_yearly_folds, rolling_origin_rows

YHAT = "yhat"


def seasonal_naive_forecast(panel: DataFrame, season: int = 7, keys=None, value: str = Y) -> DataFrame:
    """``yhat = lag(y, season)`` over the series (season 1 = naive)."""
    return panel.withColumn(YHAT, F.lag(F.col(value), season).over(by_series(keys)))


def rolling_origin_predictions(panel: DataFrame, season: int = 7, keys=None, value: str = Y, test_size: int = 30,
                               gap_size: int = 0, **folds) -> DataFrame:
    """Seasonal-naive forecasts for the test rows of row-count folds (DK-1..DK-4), from rows before the origin only.

    A test row j rows past the origin takes the last value of its season
    before the origin: ``season * ceil((j + 1) / season)`` rows back.
    """
    ks = keys_of(keys)
    reach = -(-(gap_size + test_size) // season)
    w = by_series(ks)
    back = panel.withColumn("_back", F.array(*[F.lag(F.col(value), season * i).over(w) for i in range(1, reach + 1)]))
    rows = rolling_origin_rows(back, ks, test_size=test_size, gap_size=gap_size, roles="test", **folds)
    origin = folds.get("initial_train_size", 365) + F.col("fold_idx") * folds.get("step_size", 30)
    seasons = F.floor((F.col("rn") - origin) / season).cast("int")
    return rows.select(*ks, "fold_idx", DS, F.col(value).alias(Y), F.get("_back", seasons).alias(YHAT))


def fold_test_predictions(panel: DataFrame, season: int = 7, keys=None, value: str = Y,
                          context: str = "with_history",
                          max_folds: int | None = DEFAULT_MAX_FOLDS) -> DataFrame:
    """Seasonal-naive predictions for the test rows of every yearly fold.

    Each row is the test row of at most one fold, so no row is copied.
    """
    ks = keys_of(keys)
    if context == "with_history":
        pred = seasonal_naive_forecast(panel, season, ks, value)
        test = expand_yearly_folds(pred, ks, max_folds=max_folds, roles="test")
    elif context == "test_only":
        test = expand_yearly_folds(panel, ks, max_folds=max_folds, roles="test")
        test = test.withColumn(YHAT, F.lag(F.col(value), season).over(by_series(ks + ["fold_idx"])))
    else:
        raise ValueError(f"unknown context {context!r}")
    return test.select(*ks, "fold_idx", DS, F.col(value).alias(Y), YHAT)
