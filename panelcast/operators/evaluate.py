"""Grouped accuracy metrics, error analysis, baselines and CV aggregation.

(PF-2, PF-3, PF-5, PF-6, PF-8, AG-1..AG-17, AG-21, SL-4, SL-6, WN-9, WN-10, WN-13, DK-8.)

Predictions are rows ``(model?, series_id, fold_idx?, ds, y, yhat)``; a
"group" is any list of key columns, typically ``[model, series_id,
fold_idx]``.  Scoring is one window (the previous valid row, for direction)
plus one aggregate on the same keys, so Spark plans a single exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.numeric import INF
from ..functions.windows import DS, Y, by_series

YHAT = "yhat"
NO_PAIRS = "no row has both a value and a forecast"


def prediction_column(columns: Sequence[str], date_col: str = DS) -> str:
    """PF-7 / SC-12: ``yhat1``; else the first name that starts with ``yhat``, then with ``y``; else the first but the date."""
    names = [c for c in columns if c != date_col]
    for fits in (lambda c: c == "yhat1", lambda c: c.startswith("yhat"), lambda c: c.startswith("y"), lambda c: True):
        for c in names:
            if fits(c):
                return c
    raise ValueError(f"no prediction column among {list(columns)}")


def align_forecast(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], y: str = Y) -> DataFrame:
    """JN-4: a forecast table, wide or long, joined to the actual rows on the keys and the date."""
    ks = list(keys)
    column = prediction_column([c for c in forecast.columns if c not in ks])
    return (actual.select(*ks, DS, F.col(y).alias(Y))
            .join(forecast.select(*ks, DS, F.col(column).alias(YHAT)), [*ks, DS]))


def valid_pairs(pred: DataFrame, y: str = Y, yhat: str = YHAT) -> DataFrame:
    """PF-2: keep rows where both actual and prediction are present."""
    return pred.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())


def with_direction(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT,
                   order: str = DS) -> DataFrame:
    """WN-13: the previous row's actual and prediction inside the group, and the match flag."""
    w = by_series(list(group), order)
    return (pred.withColumn("y_prev", F.lag(y).over(w))
            .withColumn("yhat_prev", F.lag(yhat).over(w))
            .withColumn("dir_match", M.direction_match(y, yhat, "y_prev", "yhat_prev")))


def score(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT,
          include_error_analysis: bool = True, only: list[str] | None = None) -> DataFrame:
    """AG-10 per group over the valid pairs: ``n`` plus the metric columns."""
    v = with_direction(valid_pairs(pred, y, yhat), group, y, yhat)
    return v.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        *M.metric_columns(y, yhat, "dir_match", include_error_analysis, only))


def score_folds(pred: DataFrame, folds: DataFrame, group: Sequence[str], y: str = Y,
                yhat: str = YHAT, include_error_analysis: bool = True) -> DataFrame:
    """PF-3: metrics for every fold of ``folds``; a fold without a valid pair is ``failed``.

    ``folds`` holds the fold dimension (one row per group); the left join
    keeps folds that produced no prediction at all.
    """
    scored = score(pred, group, y, yhat, include_error_analysis)
    j = folds.join(scored, list(group), "left")
    ok = F.coalesce(F.col("n"), F.lit(0)) > 0
    return (j.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))
            .withColumn("status", F.when(ok, "success").otherwise("failed"))
            .withColumn("error", F.when(ok, F.lit(None).cast("string"))
                        .otherwise(F.lit(NO_PAIRS))))


def error_analysis(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT, large: bool = False) -> DataFrame:
    """AG-12 per group (e = actual - predicted; population std; linear quantiles).

    ``large``: for groups with more errors than a task should hold; the same quantiles by ranks.
    """
    pairs = valid_pairs(pred, y, yhat)
    if not large:
        return pairs.groupBy(*group).agg(*M.error_analysis_columns(y, yhat))
    from .quantiles import exact_quantiles, with_groups
    quartiles = exact_quantiles(pairs, group, F.col(y) - F.col(yhat), [0.25, 0.5, 0.75])
    return with_groups(pairs.groupBy(*group).agg(*M.error_analysis_columns(y, yhat)[:-3]), quartiles.select(
        *group, *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]), group)


def absolute_errors(pred: DataFrame, y: str = Y, yhat: str = YHAT) -> DataFrame:
    """AG-13: the per-row absolute error, a row-level column (never a collected array)."""
    return pred.withColumn("abs_error", F.abs(F.col(y) - F.col(yhat)))


def baseline_predictions(actual: DataFrame, group: Sequence[str], method: str = "naive",
                         season: int = 7, y: str = Y) -> DataFrame:
    """WN-9/WN-10: baseline forecast from inside the scored rows; leading rows dropped.

    ``naive`` = previous row, ``seasonal_naive`` = ``season`` rows back.
    """
    if method == "naive":
        k = 1
    elif method == "seasonal_naive":
        k = season
    else:
        raise ValueError(f"the baseline is naive or seasonal_naive, not {method!r}")
    w = by_series(list(group))
    return (actual.withColumn(YHAT, F.lag(F.col(y), k).over(w))
            .where(F.col(YHAT).isNotNull()))


def baseline_metrics(actual: DataFrame, group: Sequence[str], method: str = "naive",
                     season: int = 7, y: str = Y) -> DataFrame:
    """AG-14: metrics of the baseline over the trimmed rows."""
    return score(baseline_predictions(actual, group, method, season, y), group, y, YHAT)


IMPROVEMENT_METRICS = ["mae", "rmse", "mape", "smape"]


def improvement_over_baseline(pred: DataFrame, group: Sequence[str], method: str = "naive",
                              y: str = Y, yhat: str = YHAT) -> DataFrame:
    """AG-15: ``(baseline - model) / baseline * 100`` for mae, rmse, mape, smape.

    The model is scored on all rows of its group: one missing value or
    prediction makes its figures, and so the improvements, missing.  The
    baseline is scored on its trimmed rows.
    """
    model = pred.select(*group, DS, y, yhat)
    whole = (model.groupBy(*group).agg(F.count_if(F.col(y).isNull() | F.col(yhat).isNull()).alias("_gaps"))
             .where(F.col("_gaps") == 0).select(*group))
    mm = score(model, group, y, yhat).select(*group, *[F.col(m).alias(f"model_{m}") for m in IMPROVEMENT_METRICS])
    bm = baseline_metrics(model.drop(yhat), group, method).select(
        *group, *[F.col(m).alias(f"baseline_{m}") for m in IMPROVEMENT_METRICS])
    mm = mm.join(whole.withColumn("_whole", F.lit(True)), list(group), "left").select(
        *group, *[F.when(F.col("_whole"), F.col(f"model_{m}")).alias(f"model_{m}") for m in IMPROVEMENT_METRICS])
    j = mm.join(bm, list(group), "inner")
    return j.select(*group, *[
        (F.try_divide(F.col(f"baseline_{m}") - F.col(f"model_{m}"), F.col(f"baseline_{m}")) * 100.0)
        .alias(f"{m}_improvement") for m in IMPROVEMENT_METRICS])


def compare_forecasts(pred_a: DataFrame, pred_b: DataFrame, group: Sequence[str],
                      labels: tuple[str, str] = ("Model 1", "Model 2"), y: str = Y) -> DataFrame:
    """AG-11 / SL-6: both metric sets side by side; winner has strictly lower MAPE, ties go to the second."""
    a = score(pred_a, group, y).select(*group, *[F.col(m).alias(f"a_{m}") for m in M.ALL_METRICS])
    b = score(pred_b, group, y).select(*group, *[F.col(m).alias(f"b_{m}") for m in M.ALL_METRICS])
    j = a.join(b, list(group), "full")
    return j.withColumn("winner", F.when(F.col("a_mape") < F.col("b_mape"), F.lit(labels[0]))
                        .otherwise(F.lit(labels[1]))) \
            .withColumn("improvement", F.abs(F.col("a_mape") - F.col("b_mape")))


def metrics_long(fold_metrics: DataFrame, id_cols: Sequence[str], metrics: Sequence[str] = M.ALL_METRICS) -> DataFrame:
    """PL-7: wide metric columns to ``(metric, value)`` rows."""
    return fold_metrics.unpivot(list(id_cols), list(metrics), "metric", "value")


def cv_summary(fold_metrics: DataFrame, group: Sequence[str], metrics: Sequence[str] = M.ALL_METRICS) -> DataFrame:
    """AG-16: over successful folds, mean / population std / min / max per metric.

    A missing value in any fold makes that metric's statistics missing,
    as ``numpy.mean`` of a list holding NaN is NaN.  A group without a
    successful fold has missing statistics and the status ``failed``.
    """
    long = metrics_long(fold_metrics.select(*group, "fold_idx", "status", *metrics), list(group) + ["fold_idx", "status"], metrics)
    ok = F.col("status") == "success"
    value = F.when(ok, F.col("value"))
    folds = F.count_if(ok)
    complete = (F.count(value) == folds) & (folds > 0)
    return long.groupBy(*group, "metric").agg(
        F.when(complete, F.avg(value)).alias("mean"),
        F.when(complete, F.stddev_pop(value)).alias("std"),
        F.when(complete, F.min(value)).alias("min"),
        F.when(complete, F.max(value)).alias("max"),
        folds.alias("fold_count"),
        F.when(folds > 0, "success").otherwise("failed").alias("status"),
    )


def fold_counts(fold_metrics: DataFrame, group: Sequence[str]) -> DataFrame:
    """AG-17 (+ PF-8): total and successful folds."""
    return fold_metrics.groupBy(*group).agg(
        F.count("fold_idx").alias("total_folds"),
        F.count_if(F.col("status") == "success").alias("successful_folds"))


def best_fold(fold_metrics: DataFrame, group: Sequence[str]) -> DataFrame:
    """SL-4: the ``fold_idx`` with the lowest MAPE among successful folds; earliest on ties."""
    ok = fold_metrics.where(F.col("status") == "success")
    key = F.struct(F.coalesce(F.col("mape"), F.lit(INF)).alias("m"), F.col("fold_idx").alias("f"))
    return ok.groupBy(*group).agg(F.min_by("fold_idx", key).alias("best_fold_idx"))


def cv_report(fold_metrics: DataFrame, group: Sequence[str]) -> DataFrame:
    """AG-21: per successful fold MAPE, MAE, RMSE and R^2."""
    return fold_metrics.where(F.col("status") == "success").select(
        *group, "fold_idx", "mape", "mae", "rmse", "r2")


def mase(pred: DataFrame, train: DataFrame, group: Sequence[str], season: int = 1,
         y: str = Y, yhat: str = YHAT) -> DataFrame:
    """DK-8: test MAE divided by the in-sample naive MAE of the train rows."""
    w = by_series(list(group))
    scale = (train.withColumn("_d", F.abs(F.col(y) - F.lag(F.col(y), season).over(w)))
             .groupBy(*group).agg(F.avg("_d").alias("naive_mae")))
    return _over_scale(pred, scale, group, y, yhat)


def yearly_mase(pred: DataFrame, panel: DataFrame, keys: Sequence[str], season: int = 1,
                y: str = Y, yhat: str = YHAT) -> DataFrame:
    """DK-8 for yearly folds: a fold trains on a prefix of the series, so its scale is a running sum over years.

    No train row is copied per fold.
    """
    ks = list(keys)
    step = F.abs(F.col(y) - F.lag(F.col(y), season).over(by_series(ks)))
    per_year = (panel.withColumn("_d", step).groupBy(*ks, F.year(DS).alias("_year"))
                .agg(F.sum("_d").alias("_s"), F.count("_d").alias("_c")))
    upto = by_series(ks, "_year").rowsBetween(Window.unboundedPreceding, 0)
    scale = per_year.select(*ks, (F.row_number().over(by_series(ks, "_year")) - 1).alias("fold_idx"),
                            F.try_divide(F.sum("_s").over(upto), F.sum("_c").over(upto)).alias("naive_mae"))
    return _over_scale(pred, scale, [*ks, "fold_idx"], y, yhat)


def _over_scale(pred: DataFrame, scale: DataFrame, group: Sequence[str], y: str, yhat: str) -> DataFrame:
    m = valid_pairs(pred, y, yhat).groupBy(*group).agg(M.mae(y, yhat).alias("mae"))
    return m.join(scale, list(group), "left").withColumn(
        "mase", F.try_divide(F.col("mae"), F.col("naive_mae")))
