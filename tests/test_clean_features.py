"""Cleaning and window features against pandas on edge-case series (FIXTURES D)."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import clean as C
from panelcast.operators import features as FE


def to_pd(df, cols):
    return df.orderBy("series_id", "ds").toPandas()[cols]


GAPPY = [None, None, 1.0, None, None, 4.0, 5.0, None, 7.0, None, None]


def test_interpolate_matches_pandas(spark, panel_df):
    df = C.add_position(panel_df({"s": daily("2020-01-01", GAPPY)}))
    got = to_pd(C.interpolate_linear(df), ["y"])["y"]
    exp = pd.Series(GAPPY, dtype=float).interpolate(method="linear")
    pd.testing.assert_series_equal(got.reset_index(drop=True), exp, check_names=False)


def test_ffill_and_drop(spark, panel_df):
    df = C.add_position(panel_df({"s": daily("2020-01-01", GAPPY)}))
    got = to_pd(C.forward_fill(df), ["y"])["y"]
    pd.testing.assert_series_equal(got.reset_index(drop=True), pd.Series(GAPPY, dtype=float).ffill(),
                                   check_names=False)
    kept = to_pd(C.drop_missing(df), ["pos"])["pos"].tolist()
    assert kept == [2, 5, 6, 8]  # positions keep their gaps
    assert C.missing_count(df).collect()[0]["n_missing"] == 7


def test_all_missing_and_unknown_method(spark, panel_df):
    df = C.add_position(panel_df({"s": daily("2020-01-01", [None, None, None])}))
    assert to_pd(C.interpolate_linear(df), ["y"])["y"].isna().all()
    with pytest.warns(UserWarning):
        assert C.handle_missing(df, "bogus") is df


def test_dedup_keep_first_and_positions(spark):
    rows = [("s", dt.date(2020, 1, 2), 5.0, 3), ("s", dt.date(2020, 1, 1), 1.0, 2), ("s", dt.date(2020, 1, 1), 2.0, 1),
            ("s", dt.date(2020, 1, 3), 7.0, 4), ("s", None, 9.0, 5)]
    raw = spark.createDataFrame(rows, "series_id string, ds date, y double, k int")
    d = C.dedup_keep_first(raw, tie="k").orderBy(F.col("ds").asc_nulls_last()).collect()
    assert [(str(r.ds), r.y, r.pos) for r in d] == [("2020-01-01", 2.0, 0), ("2020-01-02", 5.0, 2),
                                                    ("2020-01-03", 7.0, 3), ("None", 9.0, 4)]
    assert C.duplicate_count(raw).collect()[0]["n_duplicates"] == 1
    pos = {r.k: r.pos for r in C.sort_and_position(raw, tie="k").collect()}
    assert pos == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}


def test_densify_and_missing_days(spark, panel_df):
    df = panel_df({"a": [("2020-01-01", 1), ("2020-01-04", 4)], "b": [("2020-01-02", 2)]})
    dense = C.densify(df).orderBy("series_id", "ds").collect()
    assert [(r.series_id, str(r.ds), r.y, r.is_gap) for r in dense] == [
        ("a", "2020-01-01", 1.0, False), ("a", "2020-01-02", None, True), ("a", "2020-01-03", None, True),
        ("a", "2020-01-04", 4.0, False), ("b", "2020-01-02", 2.0, False)]
    assert C.missing_days(df).count() == 2


def test_outliers_and_minmax(spark, panel_df):
    vals = [1.0] * 20 + [100.0]
    df = panel_df({"s": daily("2020-01-01", vals), "c": daily("2020-01-01", [5.0] * 4)})
    flags = C.flag_outliers(df, 3.0).groupBy("series_id").agg(F.count_if("is_outlier").alias("n")).collect()
    z = np.abs((np.array(vals) - np.mean(vals)) / np.std(vals, ddof=1))
    assert {r.series_id: r.n for r in flags} == {"s": int((z > 3).sum()), "c": 0}
    scaled = C.minmax_scale(df, out="z")
    assert {r.z for r in scaled.where("series_id = 'c'").collect()} == {0.0}
    scaler = C.fit_minmax(df)
    back = C.inverse_minmax(scaled, scaler, value="z", out="y2").where("series_id = 's'").toPandas()
    np.testing.assert_allclose(back["y2"], back["y"])
    assert C.flag_outliers(df, enabled=False).where("is_outlier").count() == 0


def test_frozen_scaler_raises_when_unfitted(spark, panel_df):
    df = panel_df({"s": daily("2020-01-01", [1, 2]), "t": daily("2020-01-01", [3, 4])})
    scaler = C.fit_minmax(df.where("series_id = 's'"))
    with pytest.raises(Exception):
        C.apply_minmax(df, scaler).collect()


def series_with_zero():
    rng = np.random.default_rng(7)
    y = np.round(100 + np.cumsum(rng.normal(size=120)), 3)
    y[10] = 0.0
    return y


def test_window_features_match_pandas(spark, panel_df):
    y = series_with_zero()
    df = C.add_position(panel_df({"s": daily("2020-01-01", y), "t": daily("2020-03-01", y[::-1])}))
    out = FE.add_pct_change_features(FE.add_differencing_features(FE.add_rolling_stats(
        FE.add_lag_features(df))))
    got = out.where("series_id = 's'").orderBy("ds").toPandas()
    s = pd.Series(y)
    for k in (7, 14, 30, 90):
        np.testing.assert_allclose(got[f"lag_{k}"], s.shift(k), equal_nan=True)
    for w in (7, 14, 30):
        r = s.rolling(w)
        np.testing.assert_allclose(got[f"rolling_mean_{w}"], r.mean(), rtol=1e-9, equal_nan=True)
        np.testing.assert_allclose(got[f"rolling_std_{w}"], r.std(), rtol=1e-7, equal_nan=True)
        np.testing.assert_allclose(got[f"rolling_min_{w}"], r.min(), equal_nan=True)
        np.testing.assert_allclose(got[f"rolling_range_{w}"], r.max() - r.min(), equal_nan=True)
    for k in (1, 7, 30):
        np.testing.assert_allclose(got[f"diff_{k}"], s.diff(k), equal_nan=True)
        np.testing.assert_allclose(got[f"pct_change_{k}"], s.pct_change(k), rtol=1e-12, equal_nan=True)
    assert np.isinf(got["pct_change_1"][11])


def test_seasonal_and_fill_match_pandas(spark, panel_df):
    y = series_with_zero()[:60]
    df = C.add_position(panel_df({"s": daily("2020-01-01", y)}))
    got = FE.create_all_features(df, seasonal_periods=[7, 30], add_holiday_flag=False).orderBy("ds").toPandas()
    p = pd.DataFrame({"y": y})
    for per in (7, 30):
        m = p.groupby(p.index % per)["y"].mean()
        np.testing.assert_allclose(got[f"seasonal_mean_{per}"], p.index.map(lambda i: m[i % per]))
    exp_lag = p["y"].shift(30).bfill().ffill()
    np.testing.assert_allclose(got["lag_30"], exp_lag)
    exp_std = p["y"].rolling(7).std().bfill().ffill()
    np.testing.assert_allclose(got["rolling_std_7"], exp_std, rtol=1e-7)
    assert got.columns[:4].tolist() == ["series_id", "ds", "y", "pos"]
    assert len([c for c in got.columns if c not in ("series_id", "ds", "y", "pos")]) == 12 + 4 + 15 + 4 + 3 + 3


def test_feature_count_is_44(spark, panel_df):
    df = C.add_position(panel_df({"s": daily("2020-01-01", range(400))}))
    out = FE.create_all_features(df)
    assert len(FE.feature_names(df, out)) == 44


def test_temporal_features_match_pandas(spark, panel_df):
    days = pd.date_range("2020-12-25", "2021-01-06").tolist() + [pd.Timestamp("2020-02-29")]
    df = panel_df({"s": [(d.date(), 1.0) for d in days]})
    got = FE.add_temporal_features(df).orderBy("ds").toPandas()
    idx = pd.to_datetime(got["ds"])
    assert (got["day_of_week"] == idx.dt.dayofweek).all()
    assert (got["week_of_year"] == idx.dt.isocalendar().week.astype(int).values).all()
    assert (got["day_of_year"] == idx.dt.dayofyear).all()
    np.testing.assert_allclose(got["day_of_year_sin"], np.sin(2 * np.pi * idx.dt.dayofyear / 365))
    assert (got["is_weekend"] == (idx.dt.dayofweek >= 5).astype(int)).all()
