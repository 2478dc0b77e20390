"""No caps, no silent loss, no reach beyond the frame: small cases with known answers."""
import datetime as dt
import math

import numpy as np
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import clean as C
from panelcast.operators import evaluate as E
from panelcast.operators import features as FE
from panelcast.operators import forecast as FC
from panelcast.operators import holidays as H
from panelcast.plans import workflow as WF
from panelcast.sources import tables as T


def test_rollup_keeps_small_amounts(spark):
    raw = spark.createDataFrame([("a", dt.date(2020, 1, 1), 0.004)] * 2, "k string, d date, v double")
    assert T.daily_rollup(raw, "k", "d", "v").first().y == pytest.approx(0.008)
    exact = raw.withColumn("v", F.col("v").cast("decimal(20,3)"))
    assert T.daily_rollup(exact, "k", "d", "v").first().y == 0.008


def test_duplicates_are_cleaned_before_days_are_filled(spark):
    rows = [("s", "2020-01-05", 2.0, 1), ("s", "2020-01-05", 1.0, 2), ("s", "2020-01-07", 3.0, 3)]
    raw = spark.createDataFrame(rows, "series_id string, ds string, y double, k int").withColumn("ds", F.to_date("ds"))
    got = C.preprocess_complete(raw, tie="k", normalize=False).orderBy("ds").collect()
    assert [(str(r.ds), r.y) for r in got] == [("2020-01-05", 2.0), ("2020-01-06", 2.5), ("2020-01-07", 3.0)]
    assert [str(r.ds) for r in C.missing_days(raw).collect()] == ["2020-01-06"]


def test_a_spike_is_gone_once_it_leaves_the_frame(spark, panel_df):
    y = [1.0 + 0.1 * (i % 3) for i in range(60)]
    for spike in (1e9, math.inf):
        y[20] = spike
        got = FE.add_rolling_stats(panel_df({"s": daily("2020-01-01", y)}), [7]).orderBy("ds").collect()
        for i in range(27, 60):
            frame = np.array(y[i - 6:i + 1])
            assert got[i].rolling_mean_7 == pytest.approx(frame.mean(), rel=1e-12)
            assert got[i].rolling_std_7 == pytest.approx(frame.std(ddof=1), rel=1e-9)
            assert (got[i].rolling_min_7, got[i].rolling_max_7) == (frame.min(), frame.max())


def test_holidays_of_any_year(spark):
    days = spark.createDataFrame([(dt.date(2201, 12, 25),), (dt.date(2201, 12, 24),), (None,)], "ds date")
    assert [r.is_holiday for r in H.add_holidays(days).orderBy(F.col("ds").desc_nulls_last()).collect()] == [1, 0, 0]


def test_null_series_keep_their_positions(spark):
    rows = [(None, dt.date(2020, 1, 2), 1), (None, dt.date(2020, 1, 1), 2), ("a", None, 3), ("a", dt.date(2020, 1, 1), 4)]
    got = C.sort_and_position(spark.createDataFrame(rows, "series_id string, ds date, k int"), tie="k")
    assert {r.k: r.pos for r in got.collect()} == {2: 0, 1: 1, 4: 0, 3: 1}


def test_every_series_has_a_status(spark, panel_df):
    panel = panel_df({"long": daily("2018-01-01", np.sin(np.arange(900.0))), "short": daily("2020-01-01", [1.0] * 10)})
    cfg = FC.LinearARConfig(n_lags=3, weekly_order=1, yearly_order=0, n_forecasts=2)
    cv, _, _ = WF.cv_linear(panel, cfg)
    short = cv.where("series_id = 'short'").collect()
    assert [(r.status, r.error, r.fold_idx) for r in short] == [("failed", WF.ONE_YEAR, None)]
    assert E.fold_counts(cv.where("series_id = 'short'"), ["series_id"]).first().total_folds == 0
    summary = E.cv_summary(cv, ["series_id"])
    assert {r.status for r in summary.where("series_id = 'short'").collect()} == {"failed"}
    panel = panel.where("series_id = 'long' OR ds <= '2020-01-03'")
    final, _, coefs = WF.final_fit(panel, cfg)
    assert {(r.horizon, r.status, r.error) for r in final.where("series_id = 'short'").collect()} == {
        (h, "failed", FC.NO_ROWS) for h in (1, 2)}
    assert {r.status for r in final.where("series_id = 'long'").collect()} == {"success"}
    future = WF.future_forecast(panel, coefs, cfg, periods=5)
    assert [r.status for r in future.where("series_id = 'short'").collect()] == ["failed"]
    assert future.where("series_id = 'long' AND status = 'success'").count() == 5


def test_horizons_of_one_matrix_equal_single_fits(spark, panel_df):
    rng = np.random.default_rng(8)
    y = 10 + np.cumsum(rng.normal(size=500))
    y[[40, 41, 200]] = np.nan
    panel = panel_df({"s": daily("2019-01-01", [None if np.isnan(v) else v for v in y])})
    cfg = FC.LinearARConfig(n_lags=3, n_forecasts=4, weekly_order=1, yearly_order=0, max_changepoints=0, ridge=0.0)
    _, _, coefs = WF.final_fit(panel, cfg)
    got = {r.horizon: np.array(r.coef) for r in coefs.collect()}
    pdf = FC.design(panel, cfg).orderBy("ds").limit(350).toPandas()
    for h in range(1, 5):
        x = np.column_stack([np.ones(len(pdf)), pdf[[f"lag_{h + j}" for j in range(3)]], pdf[cfg.base_terms()]]).astype(float)
        t = pdf["y"].to_numpy(float)
        ok = ~np.isnan(x).any(axis=1) & ~np.isnan(t)
        np.testing.assert_allclose(got[h], np.linalg.lstsq(x[ok], t[ok], rcond=None)[0], rtol=1e-5, atol=1e-6)
        assert coefs.where(F.col("horizon") == h).first().n_rows == ok.sum()


def test_settings_that_exclude_each_other():
    for bad in (dict(loss="absolute"), dict(loss="huber", newest_weight=2.0), dict(newest_weight=2.0, half_life_days=30.0),
                dict(trend=False, max_changepoints=2)):
        with pytest.raises(ValueError):
            FC.LinearARConfig(**bad)


def test_a_cluster_needs_a_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace as N

    from panelcast.session import ensure_checkpoint_dir
    empty = N(get=lambda key, default=None: default)
    sc = N(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: empty)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=sc, conf=empty))


def test_improvement_needs_whole_rows(spark, panel_df):
    pred = panel_df({"s": daily("2020-01-01", np.arange(1.0, 11.0))}).withColumn("yhat", F.col("y") + 1)
    assert E.improvement_over_baseline(pred, ["series_id"]).first().mae_improvement == 0.0
    holed = pred.withColumn("yhat", F.when(F.dayofmonth("ds") > 2, F.col("yhat")))
    assert E.improvement_over_baseline(holed, ["series_id"]).first().mae_improvement is None


def test_prediction_column_and_alignment(spark, panel_df):
    assert E.prediction_column(["ds", "y2", "yhat3", "yhat1"]) == "yhat1"
    assert E.prediction_column(["ds", "trend", "y2", "yhat3"]) == "yhat3"
    assert E.prediction_column(["ds", "trend", "y2"]) == "y2" and E.prediction_column(["ds", "trend"]) == "trend"
    actual = panel_df({"s": daily("2020-01-01", [1.0, 2.0, 3.0])})
    wide = actual.where("ds > '2020-01-01'").select("series_id", "ds", (F.col("y") + 1).alias("yhat1"), F.lit(0.0).alias("yhat2"))
    got = E.align_forecast(wide, actual, ["series_id"]).orderBy("ds").collect()
    assert [(r.y, r.yhat) for r in got] == [(2.0, 3.0), (3.0, 4.0)]


def test_metadata_and_failures(spark, tmp_path, caplog):
    from panelcast.sources.files import load_coefficients, save_metadata
    assert save_metadata(spark.range(2), str(tmp_path / "m")) and spark.read.json(str(tmp_path / "m")).count() == 2
    assert load_coefficients(spark, str(tmp_path / "none")) is None and "no coefficients" in caplog.text
    assert E.absolute_errors(spark.createDataFrame([(1.0, 3.0)], "y double, yhat double")).first().abs_error == 2.0
    with pytest.raises(ValueError, match="missing required"):
        T.require_columns(spark.range(1), "ds")


def test_settings_round_trip(spark):
    cfgs = [FC.LinearARConfig(name="a", n_lags=3), FC.LinearARConfig(name="b", loss="huber")]
    assert WF.configs_of(WF.settings_table(spark, cfgs)) == cfgs
    assert set(WF.run_settings(cfgs[0])) == {"model", "data", "cv", "features", "evaluation", "visualization"}


def test_normal_quantile(spark):
    from statistics import NormalDist

    from panelcast.operators.diagnostics import normal_quantile
    ps = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.9, 0.99, 1 - 1e-7]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("q")).collect()
    assert [r.q for r in got] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-7)


def test_csv_names_with_blanks_and_differing_headers(spark, tmp_path):
    from panelcast.sources.files import read_preamble_csv
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text('p\n"The Date","Load, MW",note\n2020-01-01,1.5,a\n2020-01-02,NaN,"b, c"\n')
    got = read_preamble_csv(spark, str(tmp_path / "a"), "The Date", "Load, MW", skip=1).orderBy("The Date").collect()
    assert [(str(r[0]), r[1], r[2]) for r in got] == [("2020-01-01", 1.5, "a"), ("2020-01-02", None, "b, c")]
    (tmp_path / "a" / "y.csv").write_text("p\nDate,Load,note\n2020-01-01,1.5,a\n")
    with pytest.raises(ValueError, match="differ"):
        read_preamble_csv(spark, str(tmp_path / "a"), "The Date", "Load, MW", skip=1)
