"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads its driver tables in full (no id subsets, no row or fold
caps) and rounds its double columns to 6 places so the DuckDB oracle in
``oracle.py`` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.windows import partitions_for
from ..operators import clean as C
from ..sources import tables as T
from . import workflow as WF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name) for f in df.schema.fields])


def cleaned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's preprocessing on the daily ``orders`` panel by priority."""
    return C.preprocess_complete(T.orders_priority_panel(spark, sf_dir))


@register("cv_seasonal_naive")
def q_cv_seasonal_naive(spark, sf_dir):
    """Flagship: yearly rolling-origin CV of the 7-day seasonal-naive model."""
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return round_doubles(WF.cv_seasonal_naive(p, season=7))


# --- shared inputs ----------------------------------------------------------

from ..operators import diagnostics as D  # noqa: E402
from ..operators import ensemble as ENS  # noqa: E402
from ..operators import evaluate as E  # noqa: E402
from ..operators import features as FE  # noqa: E402
from ..operators import holidays as H  # noqa: E402
from ..operators import splits as S  # noqa: E402
from ..operators.naive import fold_test_predictions, rolling_origin_predictions  # noqa: E402

G = ["series_id", "fold_idx"]


def orders_panel(spark, sf_dir):
    return T.orders_priority_panel(spark, sf_dir)


def orders_interp(spark, sf_dir):
    """Daily orders panel densified to every day, ``pos`` assigned, gaps interpolated."""
    dense = C.add_position(C.densify(orders_panel(spark, sf_dir), flag=None))
    return C.interpolate_linear(dense)


def feature_base(spark, sf_dir):
    """The reference builds features on the cleaned, min-max scaled series."""
    return cleaned_orders(spark, sf_dir).select("series_id", "ds", "y", "pos")


def cv_predictions(spark, sf_dir, season=7, context="with_history"):
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return fold_test_predictions(p, season, context=context)


def cv_fold_metrics(spark, sf_dir):
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return WF.cv_seasonal_naive(p, season=7)


# --- sources (IO-*) ---------------------------------------------------------

@register("source_profile")
def q_source_profile(spark, sf_dir):
    return T.profile(orders_panel(spark, sf_dir))


@register("panel_rollup")
def q_panel_rollup(spark, sf_dir):
    return round_doubles(orders_panel(spark, sf_dir))


@register("segment_panel")
def q_segment_panel(spark, sf_dir):
    return round_doubles(T.orders_segment_panel(spark, sf_dir))


@register("supplier_panel")
def q_supplier_panel(spark, sf_dir):
    return round_doubles(T.lineitem_supplier_panel(spark, sf_dir))


@register("events_panel")
def q_events_panel(spark, sf_dir):
    return round_doubles(T.events_type_panel(spark, sf_dir))


@register("head_profile")
def q_head_profile(spark, sf_dir):
    """IO-9: the first five targets of each series (the limit is the feature)."""
    p = orders_panel(spark, sf_dir)
    rn = F.row_number().over(Window.partitionBy("series_id").orderBy("ds"))
    return round_doubles(p.withColumn("rn", rn).where(F.col("rn") <= 5))


# --- cleaning (CL-*) --------------------------------------------------------

@register("raw_positions")
def q_raw_positions(spark, sf_dir):
    return round_doubles(C.sort_and_position(T.orders_raw(spark, sf_dir), tie="o_orderkey"))


@register("duplicate_dates")
def q_duplicate_dates(spark, sf_dir):
    return C.duplicate_count(T.orders_raw(spark, sf_dir))


@register("dedup_first")
def q_dedup_first(spark, sf_dir):
    return round_doubles(C.dedup_keep_first(T.orders_raw(spark, sf_dir), tie="o_orderkey"))


@register("missing_targets")
def q_missing_targets(spark, sf_dir):
    return C.missing_count(C.densify(orders_panel(spark, sf_dir)))


@register("interpolated")
def q_interpolated(spark, sf_dir):
    return round_doubles(orders_interp(spark, sf_dir))


@register("forward_filled")
def q_forward_filled(spark, sf_dir):
    dense = C.add_position(C.densify(orders_panel(spark, sf_dir), flag=None))
    return round_doubles(C.forward_fill(dense))


@register("dropped_missing")
def q_dropped_missing(spark, sf_dir):
    dense = C.add_position(C.densify(orders_panel(spark, sf_dir), flag=None))
    return round_doubles(C.drop_missing(dense))


@register("outlier_flags")
def q_outlier_flags(spark, sf_dir):
    return round_doubles(C.flag_outliers(orders_panel(spark, sf_dir), threshold=3.0))


@register("outlier_counts")
def q_outlier_counts(spark, sf_dir):
    return C.outlier_count(C.flag_outliers(orders_panel(spark, sf_dir), threshold=2.5))


@register("minmax_scaled")
def q_minmax_scaled(spark, sf_dir):
    return round_doubles(C.minmax_scale(orders_panel(spark, sf_dir), out="y_scaled"))


@register("scaler_table")
def q_scaler_table(spark, sf_dir):
    return round_doubles(C.fit_minmax(orders_panel(spark, sf_dir)))


@register("frozen_scaler")
def q_frozen_scaler(spark, sf_dir):
    """CL-13: scaler fitted on the years before 1998, applied to every row."""
    p = orders_panel(spark, sf_dir)
    scaler = C.fit_minmax(p.where(F.year("ds") < 1998))
    return round_doubles(C.apply_minmax(p, scaler, out="y_scaled"))


@register("inverse_scaled")
def q_inverse_scaled(spark, sf_dir):
    p = orders_panel(spark, sf_dir)
    scaled = C.minmax_scale(p, out="y_scaled")
    return round_doubles(C.inverse_minmax(scaled, C.fit_minmax(p), value="y_scaled", out="y_restored"))


@register("preprocessed")
def q_preprocessed(spark, sf_dir):
    return round_doubles(cleaned_orders(spark, sf_dir))


@register("preprocessed_raw_rows")
def q_preprocessed_raw_rows(spark, sf_dir):
    """CL-15 on raw order rows, many per day: the first of a day stays, then the full cleaning chain."""
    return round_doubles(C.preprocess_complete(T.orders_raw(spark, sf_dir), tie="o_orderkey").drop("y_raw"))


@register("preprocessed_train_scale")
def q_preprocessed_train_scale(spark, sf_dir):
    """CL-15 with the scale fitted on the years before 1998 only: later rows may leave [0, 1]."""
    p = C.preprocess_complete(orders_panel(spark, sf_dir), fit_on=F.year("ds") < 1998)
    return round_doubles(p.drop("y_raw"))


@register("missing_days")
def q_missing_days(spark, sf_dir):
    return C.missing_days(orders_panel(spark, sf_dir))


@register("log_transform")
def q_log_transform(spark, sf_dir):
    p = C.log_transform(orders_panel(spark, sf_dir), out="y_log")
    return round_doubles(C.inverse_log_transform(p, value="y_log", out="y_back"))


@register("year_filter")
def q_year_filter(spark, sf_dir):
    return round_doubles(S.year_filter(orders_panel(spark, sf_dir), [1996, 1998]))


# --- features (SC-*, WN-*, JN-1, DK-7) --------------------------------------

@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    return round_doubles(FE.add_temporal_features(orders_panel(spark, sf_dir)))


@register("lag_features")
def q_lag_features(spark, sf_dir):
    return round_doubles(FE.add_lag_features(feature_base(spark, sf_dir)))


@register("rolling_features")
def q_rolling_features(spark, sf_dir):
    return round_doubles(FE.add_rolling_stats(feature_base(spark, sf_dir)))


@register("seasonal_features")
def q_seasonal_features(spark, sf_dir):
    return round_doubles(FE.add_seasonality_features(feature_base(spark, sf_dir)))


@register("diff_features")
def q_diff_features(spark, sf_dir):
    return round_doubles(FE.add_differencing_features(feature_base(spark, sf_dir)))


@register("pct_change_features")
def q_pct_change_features(spark, sf_dir):
    return round_doubles(FE.add_pct_change_features(feature_base(spark, sf_dir)))


@register("holiday_calendar")
def q_holiday_calendar(spark, sf_dir):
    return H.calendar_for_panel(orders_panel(spark, sf_dir))


@register("holiday_flags")
def q_holiday_flags(spark, sf_dir):
    return round_doubles(H.add_holidays(orders_panel(spark, sf_dir)))


@register("feature_table")
def q_feature_table(spark, sf_dir):
    """WN-12: the 44 features over the cleaned, scaled daily panel, then the two-way fill."""
    return round_doubles(FE.create_all_features(feature_base(spark, sf_dir)))


@register("fourier_terms")
def q_fourier_terms(spark, sf_dir):
    return round_doubles(FE.add_fourier_features(orders_panel(spark, sf_dir), yearly=10, weekly=3))


# --- splits and folds (SL-*, JN-3, AG-19/20, DK-1..4) -----------------------

@register("temporal_split")
def q_temporal_split(spark, sf_dir):
    return round_doubles(S.split_temporal(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")))


@register("split_sizes")
def q_split_sizes(spark, sf_dir):
    return S.split_sizes(S.split_temporal(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")))


@register("distinct_years")
def q_distinct_years(spark, sf_dir):
    return S.distinct_years(orders_panel(spark, sf_dir))


@register("yearly_folds")
def q_yearly_folds(spark, sf_dir):
    f = S.yearly_folds(orders_panel(spark, sf_dir))
    return f.withColumn("train_years", F.array_join(F.col("train_years"), ","))


@register("fold_rows")
def q_fold_rows(spark, sf_dir):
    x = S.expand_yearly_folds(orders_panel(spark, sf_dir))
    return round_doubles(x.select("series_id", "ds", "y", "fold_idx", "role"))


@register("fold_sizes")
def q_fold_sizes(spark, sf_dir):
    return S.fold_sizes(S.expand_yearly_folds(orders_panel(spark, sf_dir)))


@register("rolling_origin_sizes")
def q_rolling_origin_sizes(spark, sf_dir):
    """DK-1/DK-2: expanding row folds (365 train, 30 test, step 30)."""
    return S.rolling_origin_bounds(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y"))


@register("sliding_origin_sizes")
def q_sliding_origin_sizes(spark, sf_dir):
    """DK-3/DK-4: sliding 365-row train window, 7-row gap, every fold."""
    return S.rolling_origin_bounds(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y"), gap_size=7, expanding=False)


@register("rolling_origin_cv")
def q_rolling_origin_cv(spark, sf_dir):
    """DK-1/DK-2: seasonal-naive forecasts scored on every row-count fold."""
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return round_doubles(E.score(rolling_origin_predictions(p), G))


@register("gap_origin_cv")
def q_gap_origin_cv(spark, sf_dir):
    """DK-3/DK-4: as above with a sliding window and seven unseen rows before the test rows."""
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return round_doubles(E.score(rolling_origin_predictions(p, gap_size=7, expanding=False), G))


# --- metrics and CV (AG-*, PF-*, SL-4) ----------------------------------------

@register("cv_naive_test_only")
def q_cv_naive_test_only(spark, sf_dir):
    """FC-8 in the reference's prediction context: naive forecast from the test rows only."""
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return round_doubles(WF.cv_seasonal_naive(p, season=1, context="test_only"))


@register("error_analysis")
def q_error_analysis(spark, sf_dir):
    return round_doubles(E.error_analysis(cv_predictions(spark, sf_dir), G))


@register("baseline_naive")
def q_baseline_naive(spark, sf_dir):
    """AG-14: naive baseline scored inside each fold's test rows."""
    actual = cv_predictions(spark, sf_dir).select(*G, "ds", "y")
    return round_doubles(E.baseline_metrics(actual, G, "naive"))


@register("improvement_over_naive")
def q_improvement_over_naive(spark, sf_dir):
    return round_doubles(E.improvement_over_baseline(cv_predictions(spark, sf_dir), G, "naive"))


@register("compare_naive_models")
def q_compare_naive_models(spark, sf_dir):
    a = cv_predictions(spark, sf_dir, season=1)
    b = cv_predictions(spark, sf_dir, season=7)
    return round_doubles(E.compare_forecasts(a, b, G, ("naive", "seasonal_naive")))


@register("cv_summary")
def q_cv_summary(spark, sf_dir):
    return round_doubles(E.cv_summary(cv_fold_metrics(spark, sf_dir), ["series_id"]))


@register("fold_counts")
def q_fold_counts(spark, sf_dir):
    return E.fold_counts(cv_fold_metrics(spark, sf_dir), ["series_id"])


def events_cv_metrics(spark, sf_dir):
    """A panel of 30 days: no series has a yearly fold, every one has its failed row."""
    p = C.preprocess_complete(T.events_type_panel(spark, sf_dir)).select("series_id", "ds", "y")
    return WF.cv_seasonal_naive(p, season=7)


@register("events_cv")
def q_events_cv(spark, sf_dir):
    m = events_cv_metrics(spark, sf_dir)
    return round_doubles(m.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("fold_idx", "test_year")}))


@register("events_cv_summary")
def q_events_cv_summary(spark, sf_dir):
    return round_doubles(E.cv_summary(events_cv_metrics(spark, sf_dir), ["series_id"]))


@register("events_fold_counts")
def q_events_fold_counts(spark, sf_dir):
    return E.fold_counts(events_cv_metrics(spark, sf_dir), ["series_id"])


@register("best_fold")
def q_best_fold(spark, sf_dir):
    return E.best_fold(cv_fold_metrics(spark, sf_dir), ["series_id"])


@register("cv_report")
def q_cv_report(spark, sf_dir):
    return round_doubles(E.cv_report(cv_fold_metrics(spark, sf_dir), ["series_id"]))


@register("mase")
def q_mase(spark, sf_dir):
    p = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    return round_doubles(E.yearly_mase(cv_predictions(spark, sf_dir), p, ["series_id"]))


# --- plot tables and diagnostics (PL-*, ST-*, DK-9..11) -----------------------

@register("actual_vs_predicted")
def q_actual_vs_predicted(spark, sf_dir):
    return round_doubles(D.actual_vs_predicted(cv_predictions(spark, sf_dir), G))


@register("residuals")
def q_residuals(spark, sf_dir):
    return round_doubles(D.residuals(cv_predictions(spark, sf_dir), G))


@register("residual_histogram")
def q_residual_histogram(spark, sf_dir):
    return round_doubles(D.residual_histogram(cv_predictions(spark, sf_dir), G))


@register("qq_table")
def q_qq_table(spark, sf_dir):
    return round_doubles(D.qq_table(cv_predictions(spark, sf_dir), G))


@register("scatter_table")
def q_scatter_table(spark, sf_dir):
    return round_doubles(D.scatter_table(cv_predictions(spark, sf_dir), G))


@register("metrics_long")
def q_metrics_long(spark, sf_dir):
    m = cv_fold_metrics(spark, sf_dir).where(F.col("status") == "success")
    return round_doubles(E.metrics_long(m.select(*G, *E.M.ALL_METRICS), G))


@register("cv_scores")
def q_cv_scores(spark, sf_dir):
    return round_doubles(D.cv_scores(cv_fold_metrics(spark, sf_dir), ["series_id"]))


@register("error_distribution")
def q_error_distribution(spark, sf_dir):
    return round_doubles(D.error_distribution(cv_predictions(spark, sf_dir), G))


@register("forecast_overlay")
def q_forecast_overlay(spark, sf_dir):
    hist = cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")
    fc = cv_predictions(spark, sf_dir).select("series_id", "ds", "yhat")
    return round_doubles(D.overlay(hist, fc, ["series_id"]))


@register("forecast_tails")
def q_forecast_tails(spark, sf_dir):
    from ..operators.naive import seasonal_naive_forecast
    fc = seasonal_naive_forecast(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y"), 7)
    return round_doubles(D.tail_slices(fc.select("series_id", "ds", "yhat"), ["series_id"]))


def _stack(spark, sf_dir):
    members = {"naive": cv_predictions(spark, sf_dir, season=1),
               "seasonal_naive": cv_predictions(spark, sf_dir, season=7)}
    return ENS.stack_predictions(members, [*G, "ds", "y", "yhat"])


@register("model_stack")
def q_model_stack(spark, sf_dir):
    return round_doubles(_stack(spark, sf_dir))


@register("ensemble_mean")
def q_ensemble_mean(spark, sf_dir):
    return round_doubles(ENS.ensemble(_stack(spark, sf_dir), [*G, "ds"], "mean", n_models=2))


@register("ensemble_median")
def q_ensemble_median(spark, sf_dir):
    return round_doubles(ENS.ensemble(_stack(spark, sf_dir), [*G, "ds"], "median", n_models=2))


@register("ensemble_weighted")
def q_ensemble_weighted(spark, sf_dir):
    """DK-5: members weighted by the inverse of their mean CV error, per series."""
    stack = _stack(spark, sf_dir)
    folds = E.score(stack, ["model", *G]).withColumn("status", F.lit("success"))
    weights = ENS.inverse_error_weights(folds, ["series_id"])
    return round_doubles(ENS.ensemble(stack, [*G, "ds"], "weighted", weights=weights))


@register("prediction_intervals")
def q_prediction_intervals(spark, sf_dir):
    pred = cv_predictions(spark, sf_dir)
    return round_doubles(D.prediction_intervals(pred, pred.select(*G, "ds", "yhat"), ["series_id"]))


@register("residual_acf")
def q_residual_acf(spark, sf_dir):
    return round_doubles(D.residual_acf(cv_predictions(spark, sf_dir), G))


@register("dickey_fuller")
def q_dickey_fuller(spark, sf_dir):
    return round_doubles(D.dickey_fuller(cleaned_orders(spark, sf_dir).select("series_id", "ds", "y"),
                                         ["series_id"]))


# --- linear forecaster (FC-*; rows-only checks: an iterative fit has no SQL twin) ----

from ..operators import forecast as FCST  # noqa: E402

LINEAR = FCST.LinearARConfig()
LINEAR_H30 = FCST.LinearARConfig(name="linear_ar_h30", n_forecasts=30)


def _clean_panel(spark, sf_dir):
    return cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")


#: A model with a closed form: one lag and a trend, no penalty.
SMALL = dict(n_lags=1, max_changepoints=0, weekly_order=0, yearly_order=0, ridge=0.0)


@register("ar1_cv_predictions")
def q_ar1_cv_predictions(spark, sf_dir):
    """FC-1, FC-2, FC-4, FC-5: one lag and a trend, three horizons, every yearly fold."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", n_forecasts=3, **SMALL))
    return round_doubles(p)


@register("ar1_cv_metrics")
def q_ar1_cv_metrics(spark, sf_dir):
    """FC-7, FC-8: the same models scored per fold and horizon."""
    m, _, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", n_forecasts=3, **SMALL))
    return round_doubles(m)


@register("ar1_intervals")
def q_ar1_intervals(spark, sf_dir):
    """DK-9: empirical intervals of every horizon from the residuals of its own CV predictions."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", n_forecasts=3, **SMALL))
    p = p.drop("model")
    return round_doubles(D.prediction_intervals(p, p.drop("y"), ["series_id", "horizon"]))


@register("ar1_final_fit")
def q_ar1_final_fit(spark, sf_dir):
    """FC-9: fit on the train split, predictions of the test split."""
    _, p, _ = WF.final_fit(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", n_forecasts=3, **SMALL))
    return round_doubles(p)


@register("ar1_huber_fit")
def q_ar1_huber_fit(spark, sf_dir):
    """FC-2 with Huber loss: three reweighting passes."""
    _, p, _ = WF.final_fit(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1h", n_forecasts=3, loss="huber", **SMALL))
    return round_doubles(p)


@register("ar1_cv_huber")
def q_ar1_cv_huber(spark, sf_dir):
    """FC-2, FC-7 with Huber loss in every fold: each fold has row weights of its own, three passes."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1h", n_forecasts=2, loss="huber", **SMALL))
    return round_doubles(p)


@register("ar1_cv_newest")
def q_ar1_cv_newest(spark, sf_dir):
    """FC-2 with newer rows weighing up to twice as much as a fold's oldest."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1n", n_forecasts=3, newest_weight=2.0, **SMALL))
    return round_doubles(p)


@register("ar1_cv_half_life")
def q_ar1_cv_half_life(spark, sf_dir):
    """FC-2 with weights that halve with every year before a fold's end."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1d", n_forecasts=3, half_life_days=365.25, **SMALL))
    return round_doubles(p)


QUANTILES = (0.1, 0.5, 0.9)


@register("quantile_intercept")
def q_quantile_intercept(spark, sf_dir):
    """FC-2, DK-9: the quantile model with an intercept alone is the exact quantile of a fold's training rows."""
    cfg = FCST.LinearARConfig(name="level", **(SMALL | dict(n_lags=0, trend=False)), irls_iterations=1)
    return round_doubles(WF.cv_quantiles(_clean_panel(spark, sf_dir), cfg, QUANTILES))


@register("quantile_coverage")
def q_quantile_coverage(spark, sf_dir):
    """DK-9: bounds from quantile models of one lag and a trend, and the share of test values below each."""
    cfg = FCST.LinearARConfig(name="ar1q", **SMALL, irls_iterations=3)
    bounds = WF.cv_quantiles(_clean_panel(spark, sf_dir), cfg, QUANTILES)
    return round_doubles(WF.coverage(bounds, QUANTILES, G))


def _ar1_future(spark, sf_dir):
    panel, cfg = _clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", **SMALL)
    _, _, coefs = WF.final_fit(panel, cfg)
    return panel, WF.future_forecast(panel, coefs, cfg, periods=365)


@register("ar1_future")
def q_ar1_future(spark, sf_dir):
    """FC-6: a year past each series' end, each step fed back."""
    return round_doubles(_ar1_future(spark, sf_dir)[1])


@register("ar1_future_tails")
def q_ar1_future_tails(spark, sf_dir):
    """SL-5 / PL-10: history and future on one axis, its last 30, 180 and 365 days."""
    panel, future = _ar1_future(spark, sf_dir)
    return round_doubles(D.tail_slices(D.overlay(panel, future, ["series_id"]).drop("lower", "upper"), ["series_id"]))


@register("ar1_ensemble")
def q_ar1_ensemble(spark, sf_dir):
    """FC-10, FC-11: two settings trained on one panel, combined per row."""
    cfgs = [FCST.LinearARConfig(name="one", **SMALL), FCST.LinearARConfig(name="two", **SMALL)]
    _, preds, _ = WF.train_all(_clean_panel(spark, sf_dir), cfgs)
    return round_doubles(WF.ensemble_predict(preds, n_models=len(cfgs)))


@register("cv_linear_ar")
def q_cv_linear_ar(spark, sf_dir):
    """FC-7/FC-8: yearly CV of the linear AR model (30 lags, trend hinges, Fourier terms)."""
    m, _, _ = WF.cv_linear(_clean_panel(spark, sf_dir), LINEAR)
    return round_doubles(m)


@register("linear_coefficients")
def q_linear_coefficients(spark, sf_dir):
    """FC-2 / IO-6: the coefficient table of every (series, fold)."""
    _, _, c = WF.cv_linear(_clean_panel(spark, sf_dir), LINEAR)
    return c.withColumn("coef", F.transform("coef", lambda v: F.round(v, 6))).withColumn(
        "terms", F.array_join("terms", ",")).withColumn("active", F.array_join("active", ","))


@register("final_fit_metrics")
def q_final_fit_metrics(spark, sf_dir):
    """FC-9: fit on the 70 % train split, score on the last 15 %."""
    m, _, _ = WF.final_fit(_clean_panel(spark, sf_dir), LINEAR)
    return round_doubles(m)


@register("huber_final_fit")
def q_huber_final_fit(spark, sf_dir):
    """FC-2 with Huber loss (IRLS passes over weighted partial Gram matrices)."""
    cfg = FCST.LinearARConfig(name="linear_ar_huber", loss="huber")
    m, _, _ = WF.final_fit(_clean_panel(spark, sf_dir), cfg)
    return round_doubles(m)


@register("multi_horizon_forecast")
def q_multi_horizon_forecast(spark, sf_dir):
    """FC-5: direct models for horizons 1..30, predictions pivoted wide (yhat1..yhat30)."""
    _, p, _ = WF.cv_linear(_clean_panel(spark, sf_dir), LINEAR_H30)
    return round_doubles(WF.wide_forecast(p, LINEAR_H30.n_forecasts))


@register("future_forecast")
def q_future_forecast(spark, sf_dir):
    """FC-6: 365 days past each series' end; 30-day direct blocks fed back recursively."""
    panel = _clean_panel(spark, sf_dir)
    _, _, coefs = WF.final_fit(panel, LINEAR_H30)
    return round_doubles(WF.future_forecast(panel, coefs, LINEAR_H30, periods=365))


@register("linear_ensemble")
def q_linear_ensemble(spark, sf_dir):
    """FC-10/FC-11: two model settings cross-validated together, mean ensemble per row."""
    cfgs = [FCST.LinearARConfig(name="ar30"), FCST.LinearARConfig(name="ar7_noyear", n_lags=7, yearly_order=0)]
    _, preds, _ = WF.train_all(_clean_panel(spark, sf_dir), cfgs)
    return round_doubles(WF.ensemble_predict(preds, n_models=len(cfgs)))


@register("feature_table_leak_safe")
def q_feature_table_leak_safe(spark, sf_dir):
    """WN-12 with ``leak_safe``: past-only seasonal means and forward fill only (no future values)."""
    return round_doubles(FE.create_all_features(feature_base(spark, sf_dir), leak_safe=True))


@register("cv_supplier_seasonal_naive")
def q_cv_supplier_seasonal_naive(spark, sf_dir):
    """The flagship plan on the wider panel: daily shipped quantity of every supplier."""
    n = partitions_for(spark, T.lineitem_supplier_days(spark, sf_dir))
    p = C.preprocess_complete(T.lineitem_supplier_panel(spark, sf_dir), partitions=n).select("series_id", "ds", "y")
    return round_doubles(WF.cv_seasonal_naive(p, season=7, partitions=n))


# --- long series: the same results without a window over a series -----------------

from ..operators import longseries as LS  # noqa: E402


@register("long_preprocessed")
def q_long_preprocessed(spark, sf_dir):
    """CL-15 in stretches: two-pass carries instead of windows over the series."""
    return round_doubles(LS.preprocess_complete(orders_panel(spark, sf_dir)))


@register("long_feature_table")
def q_long_feature_table(spark, sf_dir):
    """WN-12 in stretches of 500 rows with a halo: five series over some 25 tasks."""
    return round_doubles(LS.create_all_features(feature_base(spark, sf_dir), size=500))


@register("event_row_features")
def q_event_row_features(spark, sf_dir):
    """WN-1..WN-5, WN-7 over raw events (irregular in time, as many rows as the table has), ordered by time and id."""
    e = T.table(spark, sf_dir, "events", ["event_id", "event_type", "ts", "value"])
    rows = e.select(F.col("event_type").alias("series_id"), F.struct("ts", "event_id").alias("ds"), "event_id", F.col("value").alias("y"))

    def features(stretch, keys):
        out = FE.add_lag_features(stretch, [1, 90], keys)
        return FE.add_differencing_features(FE.add_rolling_stats(out, [7, 30], keys), [1], keys)

    return round_doubles(LS.look_back(rows, features, back=90, size=1000, pos="pos").drop("ds"))


# --- quantiles of large groups, and steps of less than a day ------------------------

from ..operators import frequency as FR  # noqa: E402
from ..operators.quantiles import exact_quantiles  # noqa: E402

PROBS = (0.025, 0.25, 0.5, 0.75, 0.975)


@register("event_value_quantiles")
def q_event_value_quantiles(spark, sf_dir):
    """AG-12's quantiles over all raw events of a type, by ranks: no task holds a type's values."""
    e = T.table(spark, sf_dir, "events", ["event_type", "value"])
    found = exact_quantiles(e, ["event_type"], F.col("value"), PROBS)
    return round_doubles(found.select("event_type", "n", *[F.col("q")[i].alias(f"q{i}") for i in range(len(PROBS))]))


@register("large_prediction_intervals")
def q_large_prediction_intervals(spark, sf_dir):
    """DK-9 with the quantiles by ranks."""
    pred = cv_predictions(spark, sf_dir)
    return round_doubles(D.prediction_intervals(pred, pred.select(*G, "ds", "yhat"), ["series_id"], large=True))


def _hourly_events(spark, sf_dir):
    """Hourly value by event type; hours without an event are found by the series' own step."""
    e = T.table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    return FR.densify_steps(FR.step_rollup(e, "event_type", "ts", "value", 3600))


def _timed(df):
    return df.withColumn("ds", F.date_format("ds", "yyyy-MM-dd HH:mm:ss"))


@register("hourly_events")
def q_hourly_events(spark, sf_dir):
    """PF-1, CL-16, CL-6 on hours: roll-up, spine, interpolation, and the value a day before."""
    dense = _hourly_events(spark, sf_dir)
    lagged = FR.season_lags(dense, days=(1,))
    return round_doubles(_timed(C.interpolate_linear(lagged.withColumn("filled", F.col("y")), value="filled")))


@register("hourly_fourier")
def q_hourly_fourier(spark, sf_dir):
    """DK-7 with the daily order 4: terms on an axis of fractional days."""
    h = _hourly_events(spark, sf_dir).select("series_id", "ds")
    return round_doubles(_timed(FE.add_fourier_features(h, yearly=1, weekly=2, daily=4)))


@register("holiday_calendars")
def q_holiday_calendars(spark, sf_dir):
    """JN-1 for three more countries, with the holidays that move with Easter, over the panel's years."""
    years = orders_panel(spark, sf_dir)
    found = [H.calendar_for_panel(years, c) for c in ("DE", "FR", "GB")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@register("holiday_windows")
def q_holiday_windows(spark, sf_dir):
    """JN-1: flags of three countries from the date alone, and the days next to a British holiday."""
    p = orders_panel(spark, sf_dir)
    for c in ("DE", "FR", "GB"):
        p = H.add_holidays(p, country=c, name=f"is_holiday_{c.lower()}")
    return round_doubles(H.add_holiday_windows(p, "GB", before=2, after=1))


@register("forecast_paths")
def q_forecast_paths(spark, sf_dir):
    """FC-6, DK-9: a year of future paths of the one-lag model, its errors redrawn and fed back."""
    panel, cfg = _clean_panel(spark, sf_dir), FCST.LinearARConfig(name="ar1", n_forecasts=3, **SMALL)
    _, pred, coefs = WF.final_fit(panel, cfg)
    return round_doubles(WF.forecast_paths(panel, coefs, pred, cfg, periods=365, paths=200))
