"""Linear forecaster: recovery of exact models, beating naive, no bleed, future rows."""
import numpy as np
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import forecast as FC
from panelcast.plans import workflow as WF


def ar_series(n, seed, phi=0.6, c=2.0):
    rng = np.random.default_rng(seed)
    y = [10.0]
    for _ in range(n - 1):
        y.append(c + phi * y[-1] + 0.0 * rng.normal())
    return np.array(y)


def test_recovers_exact_linear_trend(spark, panel_df):
    y = 5.0 + 0.01 * np.arange(800)
    cfg = FC.LinearARConfig(n_lags=3, max_changepoints=0, weekly_order=0, yearly_order=0, ridge=0.0)
    m, pred, coefs = WF.final_fit(panel_df({"s": daily("2018-01-01", y)}), cfg)
    r = m.collect()[0]
    assert r["mae"] < 1e-6


def test_beats_naive_on_weekly_seasonal_panel(spark, panel_df):
    rng = np.random.default_rng(3)
    t = np.arange(365 * 4)
    data = {f"s{i}": daily("2016-01-01", 10 + 3 * np.sin(2 * np.pi * t / 7 + i) + 0.3 * rng.normal(size=len(t)))
            for i in range(3)}
    panel = panel_df(data)
    cfg = FC.LinearARConfig(n_lags=7, max_changepoints=4)
    lin, _, _ = WF.cv_linear(panel, cfg)
    naive = WF.cv_seasonal_naive(panel, season=1)
    a = {(r.series_id, r.fold_idx): r.mae for r in lin.collect()}
    b = {(r.series_id, r.fold_idx): r.mae for r in naive.collect()}
    assert set(a) == set(b) and len(a) == 9
    assert all(a[k] < b[k] for k in a)


def test_panel_equals_single_runs(spark, panel_df):
    rng = np.random.default_rng(11)
    ya = 50 + np.cumsum(rng.normal(size=900))
    yb = 20 + 5 * np.sin(np.arange(900) / 3.0)
    cfg = FC.LinearARConfig(n_lags=5, max_changepoints=3)
    both = WF.cv_linear(panel_df({"a": daily("2017-01-01", ya), "b": daily("2017-01-01", yb)}), cfg)[0]
    only_a = WF.cv_linear(panel_df({"a": daily("2017-01-01", ya)}), cfg)[0]
    got = {r.fold_idx: r.mae for r in both.where("series_id = 'a'").collect()}
    exp = {r.fold_idx: r.mae for r in only_a.collect()}
    assert got.keys() == exp.keys()
    for k in got:
        assert got[k] == pytest.approx(exp[k], rel=1e-9)


def test_one_year_series_fails_gracefully(spark, panel_df):
    m = WF.cv_seasonal_naive(panel_df({"s": daily("2020-02-01", [1.0] * 30)}))
    r = m.collect()
    assert len(r) == 1 and r[0]["status"] == "failed" and r[0]["error"] == WF.ONE_YEAR


def test_multi_horizon_and_future(spark, panel_df):
    y = 10 + np.sin(np.arange(1000) * 2 * np.pi / 7)
    panel = panel_df({"s": daily("2018-01-01", y), "t": daily("2018-01-01", y + 1)})
    cfg = FC.LinearARConfig(n_lags=7, n_forecasts=3, max_changepoints=2)
    _, pred, _ = WF.cv_linear(panel, cfg)
    wide = WF.wide_forecast(pred, 3)
    assert {"yhat1", "yhat2", "yhat3"} <= set(wide.columns)
    _, _, coefs = WF.final_fit(panel, cfg)
    fut = WF.future_forecast(panel, coefs, cfg, periods=10)
    rows = fut.orderBy("series_id", "step").collect()
    assert len(rows) == 20 and [r.step for r in rows[:10]] == list(range(1, 11))
    exp = 10 + np.sin(np.arange(1000, 1010) * 2 * np.pi / 7)
    np.testing.assert_allclose([r.yhat for r in rows[:10]], exp, atol=0.05)


def test_huber_downweights_outliers(spark, panel_df):
    y = 5.0 + 0.01 * np.arange(700)
    y_bad = y.copy()
    y_bad[::37] += 50.0
    base = FC.LinearARConfig(n_lags=2, max_changepoints=0, weekly_order=0, yearly_order=0)
    hub = FC.LinearARConfig(name="h", n_lags=2, max_changepoints=0, weekly_order=0, yearly_order=0,
                            loss="huber", irls_iterations=3)
    p = panel_df({"s": daily("2018-01-01", y_bad)})
    ls = WF.final_fit(p, base)[0].collect()[0]["median_ae"]
    hb = WF.final_fit(p, hub)[0].collect()[0]["median_ae"]
    assert hb < ls


def test_coefficient_save_load(spark, panel_df, tmp_path):
    from panelcast.sources.files import load_coefficients, model_summary, save_coefficients
    y = 5.0 + 0.01 * np.arange(400)
    cfg = FC.LinearARConfig(n_lags=2, max_changepoints=0, weekly_order=0, yearly_order=0)
    _, _, coefs = WF.final_fit(panel_df({"s": daily("2018-01-01", y)}), cfg)
    assert save_coefficients(coefs, str(tmp_path / "m"))
    back = load_coefficients(spark, str(tmp_path / "m"), cfg.name)
    assert back.count() == 1 and back.collect()[0]["terms"] == cfg.terms()
    assert load_coefficients(spark, str(tmp_path / "missing")) is None
    assert model_summary(back, cfg.to_json()).collect()[0]["n_series"] == 1


def test_numpy_base_terms_equal_spark(spark, panel_df):
    cfg = FC.LinearARConfig(max_changepoints=5)
    df = FC.design(panel_df({"s": daily("2019-12-20", np.arange(900.0))}), cfg)
    pdf = df.orderBy("ds").toPandas()
    got = FC.base_terms_np(pdf["_day"].to_numpy(float), pdf["_start"].to_numpy(float), cfg)
    np.testing.assert_allclose(got, pdf[cfg.base_terms()].to_numpy(float), rtol=1e-12, atol=1e-12)


def test_plot_tables_and_pipeline(spark, panel_df, tmp_path):
    from panelcast.operators.diagnostics import plot_tables
    y = 10 + np.sin(np.arange(1200) * 2 * np.pi / 7)
    panel = panel_df({"s": daily("2017-01-01", y)})
    naive = WF.fold_test_predictions(panel, 7)
    tabs = plot_tables(naive, ["series_id", "fold_idx"])
    assert set(tabs) >= {"residuals", "qq", "scatter"} and tabs["residual_histogram"].count() == 3 * 30
    cfg = FC.LinearARConfig(n_lags=7, max_changepoints=2)
    res = WF.execute_pipeline(panel, str(tmp_path / "out"), cfg)
    assert res["status"] == "success", res["error"]
    assert spark.read.parquet(res["tables"]["cv_metrics"]).count() == 3
    assert spark.read.parquet(str(tmp_path / "out" / "runs")).count() == 1
