"""Golden example (FIXTURES A4) and metric edge cases."""
import math

import numpy as np
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import evaluate as E

ACTUAL = [100, 110, 105, 120, 115, 125, 130]
PRED = [102, 108, 107, 118, 117, 128, 128]


def pred_frame(spark, actual, pred, sid="s"):
    import datetime as dt
    rows = [(sid, 0, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(a) if a is not None else None,
             float(p) if p is not None else None) for i, (a, p) in enumerate(zip(actual, pred))]
    return spark.createDataFrame(rows, "series_id string, fold_idx int, ds date, y double, yhat double")


def test_golden_metrics(spark):
    r = E.score(pred_frame(spark, ACTUAL, PRED), ["series_id", "fold_idx"]).collect()[0]
    expected = dict(mae=2.142857142857143, rmse=2.1712405933672376, mape=1.866743194693505,
                    smape=1.8612274509672604, r2=0.9528571428571428, median_ae=2.0, mre=0.01866743194693505,
                    directional_accuracy=83.33333333333334, forecast_bias=0.42857142857142855)
    for k, v in expected.items():
        assert r[k] == pytest.approx(v, rel=1e-12), k
    assert r["n"] == 7


def test_golden_error_analysis(spark):
    r = E.error_analysis(pred_frame(spark, ACTUAL, PRED), ["series_id"]).collect()[0]
    assert r["mean_error"] == pytest.approx(-0.42857142857142855)
    assert r["std_error"] == pytest.approx(2.1285234893930483)
    assert (r["min_error"], r["max_error"]) == (-3.0, 2.0)
    assert (r["positive_errors"], r["negative_errors"]) == (3, 4)
    assert (r["q25"], r["q50"], r["q75"]) == (-2.0, -2.0, 2.0)


def test_golden_naive_baseline_and_improvement(spark):
    df = pred_frame(spark, ACTUAL, PRED)
    b = E.baseline_metrics(df.drop("yhat"), ["series_id", "fold_idx"], "naive").collect()[0]
    assert b["mae"] == pytest.approx(8.333333333333334)
    assert b["rmse"] == pytest.approx(9.128709291752768)
    imp = E.improvement_over_baseline(df, ["series_id", "fold_idx"], "naive").collect()[0]
    assert imp["mae_improvement"] == pytest.approx(74.28571428571429)
    with pytest.raises(ValueError):
        E.baseline_predictions(df, ["series_id"], "bogus")


def test_zero_actuals(spark):
    r = E.score(pred_frame(spark, [0, 0, 0], [0, 1, 0]), ["series_id"]).collect()[0]
    assert math.isinf(r["mape"]) and math.isinf(r["mre"])
    # 0/0 counts as 0 in sMAPE; 1 vs 0 gives 200
    assert r["smape"] == pytest.approx(200.0 / 3)
    # constant actuals: SST = 0 and SSE > 0 -> 0
    assert r["r2"] == 0.0
    perfect = E.score(pred_frame(spark, [3, 3], [3, 3]), ["series_id"]).collect()[0]
    assert perfect["r2"] == 1.0


def test_one_row_and_nan_pairs(spark):
    one = E.score(pred_frame(spark, [5], [4]), ["series_id"]).collect()[0]
    assert one["r2"] is None and one["directional_accuracy"] is None and one["mae"] == 1.0
    mixed = E.score(pred_frame(spark, [1, None, 3, 4], [1, 2, None, 5]), ["series_id"]).collect()[0]
    assert mixed["n"] == 2  # only rows with both values


def test_failed_fold_status(spark):
    df = pred_frame(spark, [1, 2], [None, None])
    folds = spark.createDataFrame([("s", 0)], "series_id string, fold_idx int")
    r = E.score_folds(df, folds, ["series_id", "fold_idx"]).collect()[0]
    assert r["status"] == "failed" and r["n"] == 0


def test_cv_summary_population_std_and_best_fold(spark):
    rows = [("s", i, "success", m) for i, m in enumerate([3.0, 1.0, 1.0])] + [("s", 3, "failed", None)]
    fm = spark.createDataFrame(rows, "series_id string, fold_idx int, status string, mape double")
    s = E.cv_summary(fm, ["series_id"], ["mape"]).collect()[0]
    assert s["mean"] == pytest.approx(5 / 3) and s["std"] == pytest.approx(np.std([3, 1, 1]))
    assert s["fold_count"] == 3
    assert E.best_fold(fm, ["series_id"]).collect()[0]["best_fold_idx"] == 1
    c = E.fold_counts(fm, ["series_id"]).collect()[0]
    assert (c["total_folds"], c["successful_folds"]) == (4, 3)


def test_compare_tie_goes_to_second(spark):
    a = pred_frame(spark, [1, 2, 3], [1, 2, 4])
    out = E.compare_forecasts(a, a, ["series_id"], ("A", "B")).collect()[0]
    assert out["winner"] == "B" and out["improvement"] == 0.0


def test_series_do_not_bleed(spark, panel_df):
    a = daily("2020-01-01", [1, 2, 3, 4])
    b = daily("2020-01-01", [10, 10, 10, 10])
    df = panel_df({"a": a, "b": b}).withColumn("fold_idx", F.lit(0))
    preds = E.baseline_predictions(df, ["series_id", "fold_idx"], "naive")
    got = {(r.series_id, str(r.ds)): r.yhat for r in preds.collect()}
    assert got[("b", "2020-01-02")] == 10.0 and got[("a", "2020-01-02")] == 1.0


def test_ensembles(spark):
    import datetime as dt

    from panelcast.operators import ensemble as ENS
    d = dt.date(2020, 1, 1)
    rows = [("a", "s", d, 1.0), ("b", "s", d, 3.0), ("c", "s", d, 8.0),
            ("a", "s", d + dt.timedelta(1), 1.0), ("b", "s", d + dt.timedelta(1), None)]
    st = spark.createDataFrame(rows, "model string, series_id string, ds date, yhat double")
    mean = {r.ds: r.yhat for r in ENS.ensemble(st, ["series_id", "ds"], "mean").collect()}
    assert mean[d] == 4.0 and mean[d + dt.timedelta(1)] is None  # a missing member makes the mean missing
    assert ENS.ensemble(st, ["series_id", "ds"], "median").where(F.col("ds") == d).collect()[0]["yhat"] == 3.0
    w = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.0)], "model string, weight double")
    wt = ENS.ensemble(st, ["series_id", "ds"], "weighted", weights=w).where(F.col("ds") == d).collect()[0]
    assert wt["yhat"] == pytest.approx((3 * 1 + 1 * 3) / 4)
    fm = spark.createDataFrame([("a", "s", "success", 2.0), ("a", "s", "success", 4.0)],
                               "model string, series_id string, status string, mae double")
    assert ENS.inverse_error_weights(fm, ["series_id"]).collect()[0]["weight"] == pytest.approx(1 / 3)
