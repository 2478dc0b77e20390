"""Robust losses, quantiles and recency weights in every fold against direct fits; horizons; future blocks."""
import numpy as np
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import forecast as FC
from panelcast.plans import workflow as WF


def series(n, seed=1, spikes=True):
    rng = np.random.default_rng(seed)
    y = [5.0]
    for i in range(1, n):
        y.append(2 + 0.6 * y[-1] + rng.normal())
    y = np.array(y)
    if spikes:
        y[rng.integers(0, n, n // 40)] += 30
    return [None if i % 53 == 7 else float(v) for i, v in enumerate(y)]


CFG = dict(n_lags=2, n_forecasts=2, max_changepoints=0, weekly_order=1, yearly_order=0, ridge=0.0)


def direct(values, years, cfg, weights):
    """Coefficients by (fold, horizon) from all rows at once; ``weights(X, y, t, beta)``: None, or those of the next pass."""
    y = np.array([np.nan if v is None else v for v in values])
    day = np.arange(len(y)) + (np.datetime64("2018-01-01") - np.datetime64("1970-01-01")).astype(int)
    base = FC.base_terms_np(day.astype(float), np.full(len(y), float(day[0])), cfg)
    out = {}
    for h in range(1, cfg.n_forecasts + 1):
        lags = np.column_stack([np.concatenate([np.full(k, np.nan), y[:-k]]) for k in range(h, h + cfg.n_lags)])
        x = np.column_stack([np.ones(len(y)), lags, base])
        for fold in range(years.max()):
            ok = (years <= fold) & ~np.isnan(y) & ~np.isnan(x).any(axis=1)
            xx, yy, tt = x[ok], y[ok], np.arange(len(y))[ok] / 365.25
            beta, passes = None, weights(xx, yy, tt, None)
            while passes is not None:
                w, target = passes
                beta = np.linalg.solve((xx * w[:, None]).T @ xx, (xx * w[:, None]).T @ target)
                passes = weights(xx, yy, tt, beta)
            out[fold, h] = beta
    return out


def check(spark, panel_df, cfg, make_weights):
    values = series(1100)
    rows = daily("2018-01-01", values)
    years = np.array([d.year - 2018 for d, _ in rows])
    _, _, coefs = WF.cv_linear(panel_df({"s": rows, "short": rows[:20]}), cfg)
    got = {(r.fold_idx, r.horizon): r.coef for r in coefs.collect()}
    want = direct(values, years, cfg, make_weights())
    assert got.keys() == want.keys() and len(got) == 6
    for k, beta in want.items():
        assert got[k] == pytest.approx(beta, rel=1e-6, abs=1e-8)


def test_huber_in_every_fold(spark, panel_df):
    def weights(x, y, t, beta, state={}):
        if beta is None:
            state["n"] = 0
            return np.ones(len(y)), y
        state["n"] += 1
        if state["n"] > 3:
            return None
        r = np.abs(y - x @ beta)
        limit = 1.345 * np.median(r) / 0.6745
        return np.where(r > limit, limit / np.maximum(r, 1e-300), 1.0), y
    check(spark, panel_df, FC.LinearARConfig(loss="huber", **CFG), lambda: weights)


@pytest.mark.parametrize("how", [dict(newest_weight=4.0), dict(half_life_days=90.0)])
def test_recency_weights_follow_the_folds_end(spark, panel_df, how):
    def weights(x, y, t, beta):
        if beta is not None:
            return None
        end = t.max()
        return (1 + 3 * t / end if "newest_weight" in how else 0.5 ** ((end - t) * 365.25 / 90)), y
    check(spark, panel_df, FC.LinearARConfig(**how, **CFG), lambda: weights)


def test_quantiles_cover_their_share_and_do_not_cross(spark, panel_df):
    quantiles = (0.1, 0.5, 0.9)
    cfg = FC.LinearARConfig(irls_iterations=3, **(CFG | dict(n_forecasts=1, weekly_order=0)))
    panel = panel_df({f"s{i}": daily("2018-01-01", series(1400, i, spikes=False)) for i in range(2)})
    bounds = WF.cv_quantiles(panel, cfg, quantiles)
    rows = bounds.collect()
    assert all(r.q10 <= r.q50 <= r.q90 for r in rows if r.q10 is not None)
    assert all((r.q10 is None) == (r.q90 is None) for r in rows)
    covered = {r.quantile: r.covered for r in WF.coverage(bounds, quantiles, []).collect()}
    assert all(abs(covered[q] - q) < 0.06 for q in quantiles)


def test_pinball_loss_falls_below_that_of_shifted_least_squares(spark, panel_df):
    rng = np.random.default_rng(4)
    x = np.arange(900) / 365.25
    y = 3 + x + (1 + 2 * x) * np.abs(rng.normal(size=900))  # spread grows, so quantile lines fan out
    plain = dict(n_lags=0, max_changepoints=0, weekly_order=0, yearly_order=0, ridge=0.0)
    panel = panel_df({"s": daily("2018-01-01", y)})

    def loss(passes):
        cfg = FC.LinearARConfig(loss="quantile", quantile=0.9, irls_iterations=passes, **plain)
        _, _, coefs = WF.final_fit(panel, cfg, train_ratio=0.9, val_ratio=0.0)
        b0, b1 = coefs.first().coef
        r = (y - b0 - b1 * x)[:810]
        return np.maximum(0.9 * r, -0.1 * r).mean()
    assert loss(8) < 0.99 * loss(0)


def test_horizons_cost_one_dot_product_each(spark, panel_df):
    panel = panel_df({"s": daily("2018-01-01", series(800))})
    shapes = set()
    for h in (1, 8, 30):
        cfg = FC.LinearARConfig(**(CFG | dict(n_forecasts=h)))
        _, pred, coefs = WF.cv_linear(panel, cfg)
        plan = pred._jdf.queryExecution().executedPlan().toString()
        shapes.add((plan.count("zip_with"), plan.count("map_from_entries")))
    assert len(shapes) == 1 and shapes.pop()[0] == 1  # evaluated once, in one transform over the models
    by = {r.horizon: np.array(r.coef) for r in coefs.where("fold_idx = 0").collect()}
    y = {d: np.nan if v is None else v for d, v in daily("2018-01-01", series(800))}
    days = sorted(y)
    for r in pred.where("fold_idx = 0 AND yhat IS NOT NULL AND day(ds) = 15").collect():
        at = days.index(r.ds)
        base = FC.base_terms_np(np.array([float((np.datetime64(r.ds) - np.datetime64("1970-01-01")).astype(int))]),
                                np.array([float((np.datetime64("2018-01-01") - np.datetime64("1970-01-01")).astype(int))]), cfg)[0]
        x = np.concatenate([[1.0], [y[days[at - k]] for k in range(r.horizon, r.horizon + 2)], base])
        assert r.yhat == pytest.approx(float(x @ by[r.horizon]), rel=1e-9)


def test_a_gap_in_the_horizons_is_a_failed_row(spark, panel_df):
    cfg = FC.LinearARConfig(**(CFG | dict(n_forecasts=3)))
    panel = panel_df({"a": daily("2018-01-01", series(400, spikes=False)[:-1] + [1.0]), "b": daily("2018-01-01", [1.0] * 400)})
    _, _, coefs = WF.final_fit(panel, cfg)
    for gone in (1, 2):
        out = WF.future_forecast(panel, coefs.where(~((F.col("series_id") == "a") & (F.col("horizon") == gone))), cfg, periods=7)
        rows = {s: [r for r in out.collect() if r.series_id == s] for s in "ab"}
        assert [(r.status, r.error) for r in rows["a"]] == [("failed", f"no fitted model for horizon {gone}")]
        assert len(rows["b"]) == 7
